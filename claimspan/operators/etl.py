"""Table writes, de-duplication, claim conversion and routing, and change jobs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimspan.functions.measures import normalize_status
from claimspan.functions.ranking import dense_numbers
from claimspan.operators import versions
from claimspan.operators.id_index import IdIndex
from claimspan.session import beside, remove_dir, scratch_dir
from claimspan.sources.readers import path_exists, read_inbound_claims
from claimspan.sources.schemas import INBOUND_COLUMNS, RUN_LOG

# ---------------------------------------------------------------- tables


def copy_table(source: DataFrame, target: str) -> None:
    """Full copy into a Parquet folder, replacing what is there. The source may be JDBC, Parquet, ..."""
    source.write.mode("overwrite").parquet(target)


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    path: str | None = None,
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, Sequence[str]] | None = None,
) -> None:
    """Create a table from a frame. The layout takes the place of indexes: ``partition_by`` lets
    scans skip folders, ``bucket_by`` lets joins and aggregates on those columns skip the shuffle."""
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        count, columns = bucket_by
        writer = writer.bucketBy(count, *columns).sortBy(*columns)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    df.write.mode("append").format("parquet").saveAsTable(name)


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace rows and schema: an overwriting ``saveAsTable`` drops and re-creates a Parquet table.

    The old rows are gone once that begins. ``replace_version`` keeps them until the new ones are complete.
    """
    save_table(df, name, "overwrite", path)


def replace_version(df: DataFrame, store: str, name: str = "data", partition_by: Sequence[str] = ()) -> None:
    """Replace rows and schema of a table of a version store, in one switch behind the write."""
    with versions.change(df.sparkSession, store) as change:
        change.replace(name, df, partition_by)


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Target rows with the updates applied by key; of several updates to one key the latest wins.

    A row without a full key cannot match, so it is always kept or added. ``upsert_table`` is the job
    that writes, and reduces the updates only once.
    """
    newest = latest_rows(updates, keys, order)
    return target.join(newest.select(*keys), list(keys), "left_anti").unionByName(newest)


def upsert_table(
    spark: SparkSession, store: str, updates: DataFrame, keys: Sequence[str], order: Sequence[str] = (),
    partition_by: Sequence[str] = (), name: str = "data",
) -> None:
    """Apply updates to a table of the version store at ``store``; the first ones make the table.

    The updates are reduced to one row per key. Of a table partitioned by ``partition_by`` only the partitions that
    hold or get an updated row are written, into new folders; the switch to the new version comes last, so a run that
    stops at any point changes nothing and can be repeated.
    """
    with versions.change(spark, store) as change:
        newest = latest_rows(updates, keys, order)
        if name in change.tables:
            change.merge(name, newest, keys)
        else:
            change.replace(name, newest, partition_by)


# ---------------------------------------------------------------- de-duplication


def dedupe(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Drop rows that repeat completely, or repeat the keys. Copies fold inside each task first."""
    return latest_rows(df, keys, []) if keys else df.dropDuplicates()


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the highest by ``order``, further ties by the remaining columns.

    The maximum of a struct is folded inside each task, so a key with very many versions never
    gathers in one sort as ``row_number`` would make it.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not rest and not order:
        return df.dropDuplicates()
    newest = F.max(F.struct(*order, *rest)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


#: The name used by the inventory.
dedupe_latest = latest_rows


# ---------------------------------------------------------------- inbound claims

# Target types of the converted columns and the reject texts.
ID_COLUMNS = ("claim_id", "member_id", "provider_id")
AMOUNT_COLUMNS = ("billed_amount", "allowed_amount", "paid_amount")
TEXT_LIMITS = {"claim_status": 15, "diagnosis_code": 10, "procedure_code": 10}
DATE_COLUMNS = ("service_date", "admit_date", "discharge_date")
NO_MEMBER = "member not found"
NO_PROVIDER = "provider not found"
ALREADY_LOADED = "claim already loaded"
REPEATED = "claim repeated in file"


def convert_claims(raw: DataFrame, on_error: str = "reject") -> DataFrame:
    """Add a typed ``conv_*`` column per inbound column and ``conversion_errors`` ("" when all convert).

    Empty text stays NULL and is no error, except for the claim id. ``on_error="fail"`` stops the run at the first bad value.
    """
    if on_error not in ("reject", "fail"):
        raise ValueError("on_error must be 'reject' or 'fail'")
    typed: dict[str, Column] = {}
    errors: list[Column] = []

    def add(name: str, value: Column, message: str) -> None:
        typed[f"conv_{name}"] = value
        given = F.col(name).isNotNull() & (F.trim(F.col(name)) != "")
        errors.append(F.when(given & F.col(f"conv_{name}").isNull(), F.lit(f"{name}: {message}")))

    for name in ID_COLUMNS:
        add(name, F.trim(F.col(name)).try_cast("bigint"), "not a whole number")
    for name in AMOUNT_COLUMNS:
        add(name, F.trim(F.col(name)).try_cast("decimal(10,2)"), "not a numeric(10,2)")
    for name, limit in TEXT_LIMITS.items():
        add(name, F.when(F.length(name) <= limit, F.col(name)), f"longer than {limit}")
    for name in DATE_COLUMNS:
        add(name, F.try_to_date(F.trim(F.col(name)), "yyyy-MM-dd"), "not a date")
    errors.append(F.when(F.coalesce(F.trim("claim_id"), F.lit("")) == "", F.lit("claim_id: missing")))
    typed["conv_claim_status"] = normalize_status(typed["conv_claim_status"])
    converted = raw.select("*", *[c.alias(n) for n, c in typed.items()]).withColumn(
        "conversion_errors", F.concat_ws("; ", *errors)
    )
    if on_error == "fail":
        stop = F.raise_error(F.concat(F.lit("claim conversion failed: "), "conversion_errors")).cast("string")
        converted = converted.withColumn(
            "conversion_errors", F.when(F.col("conversion_errors") != "", stop).otherwise(F.col("conversion_errors"))
        )
    return converted


def classify_claims(
    claims: DataFrame, members: DataFrame, providers: DataFrame, errors: str | None = None, prefix: str = ""
) -> DataFrame:
    """Add ``reject_reason``: conversion error, then unknown member, then unknown provider, else NULL."""
    member_keys = members.select(F.col("member_id").alias("_member")).distinct()
    provider_keys = providers.select(F.col("provider_id").alias("_provider")).distinct()
    reason = F.when(F.col("_member").isNull(), F.lit(NO_MEMBER)).when(F.col("_provider").isNull(), F.lit(NO_PROVIDER))
    if errors:
        reason = F.when(F.col(errors) != "", F.col(errors)).otherwise(reason)
    return (
        claims.join(member_keys, F.col(f"{prefix}member_id") == F.col("_member"), "left")
        .join(provider_keys, F.col(f"{prefix}provider_id") == F.col("_provider"), "left")
        .withColumn("reject_reason", reason)
        .drop("_member", "_provider")
    )


def route_claims(
    claims: DataFrame, members: DataFrame, providers: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of one classification, so every claim lands in exactly one of them."""
    classified = classify_claims(claims, members, providers)
    accepted = classified.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return accepted, classified.filter(F.col("reject_reason").isNotNull())


def write_rejects(df: DataFrame, path: str) -> None:
    """Rejected claims as CSV with header, replacing the previous run."""
    df.write.mode("overwrite").option("header", True).csv(path)


# The run-log statuses.
SUCCESS = "Success"
NO_FILE = "No file"
FAILED = "Failed"
NOT_ARCHIVED = "Not archived"


@dataclass(frozen=True)
class LoadResult:
    status: str
    source_rows: int
    rows_inserted: int
    rows_rejected: int

    @property
    def balanced(self) -> bool:
        return self.source_rows == self.rows_inserted + self.rows_rejected


def typed_claims(classified: DataFrame) -> DataFrame:
    """The typed claim columns of a converted frame under their table names."""
    return classified.select(
        *[F.col(f"conv_{c}").alias(c) for c in INBOUND_COLUMNS if c != "denial_reason"], "denial_reason"
    )


def key_claims(rows: DataFrame, members: DataFrame, providers: DataFrame) -> DataFrame:
    """_row, conv_claim_id and reject_reason of inbound ``rows``: converted and classified, by their keys only.

    So the lookups shuffle a few numbers a row, and no claim texts.
    """
    keys = convert_claims(rows).select("_row", *[f"conv_{c}" for c in ID_COLUMNS], "conversion_errors")
    return classify_claims(keys, members, providers, "conversion_errors", "conv_").select(
        "_row", "conv_claim_id", "reject_reason"
    )


def settle_claims(
    rows: DataFrame, classified: DataFrame, loaded_ids: DataFrame | None, stage: Callable[[DataFrame, str], DataFrame]
) -> DataFrame:
    """Inbound ``rows`` with a ``reject_reason``, also for claims that are loaded already or repeated in the batch.

    ``rows`` need a column ``_row`` with a different number in each row, and ``classified`` is their ``key_claims``; both
    must be staged, as they are read several times. ``stage`` writes a frame under a name and reads it again. Of the
    rows of one id the latest stays.

    Reasons are found by row number and id alone, and only of ids that repeat whole rows are compared. Rejected rows
    take no part in that, so that rows without an id gather nowhere. Ids, row numbers and reasons are staged: where
    they are few, Spark knows it and sends them to the rows instead of shuffling these.
    """
    refused = classified.filter(F.col("reject_reason").isNotNull()).select("_row", "reject_reason")
    sound = classified.filter(F.col("reject_reason").isNull()).select("_row", "conv_claim_id")
    ids = sound.groupBy("conv_claim_id").agg(F.count("*").alias("_n"))
    if loaded_ids is not None:
        known = loaded_ids.select(F.col("claim_id").alias("conv_claim_id")).distinct().withColumn("_known", F.lit(True))
        ids = ids.join(known, "conv_claim_id", "left")
    else:
        ids = ids.withColumn("_known", F.lit(None).cast("boolean"))
    ids = stage(ids.filter("_known or _n > 1").select("conv_claim_id", "_known"), "claims-ids")
    marked = sound.join(ids, "conv_claim_id")
    several = stage(marked.filter("_known is null").select("_row"), "claims-several")
    reasons = [refused, marked.filter("_known").select("_row", F.lit(ALREADY_LOADED).alias("reject_reason"))]
    compared = convert_claims(rows.join(several, "_row", "left_semi"))
    rest = [c for c in compared.columns if c not in ("conv_claim_id", "conv_service_date", "_row")]
    newest = F.max(F.struct("conv_service_date", *rest, "_row")).alias("_best")
    best = compared.groupBy("conv_claim_id").agg(newest).select("_best._row")
    reasons.append(several.join(best, "_row", "left_anti").select("_row", F.lit(REPEATED).alias("reject_reason")))
    return rows.join(stage(reduce(DataFrame.unionByName, reasons), "claims-reasons"), "_row", "left")


def settled_claims(settled: DataFrame) -> DataFrame:
    """The rows of ``settle_claims`` converted, with ``reject_reason`` last."""
    converted = convert_claims(settled)
    return converted.select(*[c for c in converted.columns if c != "reject_reason"], "reject_reason")


def load_new_claims(
    spark: SparkSession,
    path: str,
    members: DataFrame,
    providers: DataFrame,
    target: str,
    reject_path: str,
    run_log: str,
    run_timestamp: datetime,
    archive_dir: str | None = None,
    package_name: str = "load_new_claims",
) -> LoadResult:
    """Check the file, convert, route, append, write rejects, archive and log one run.

    Loaded ids are looked up in an index beside the target, ``<target>_ids``, of which only the buckets that the file's
    ids fall into are opened; it is made from the target by the first run. Every source row is inserted or rejected with a reason; claim ids the target already holds and
    further rows of one id in the file are rejected too, so a repeated run inserts nothing twice.
    Read, classified and settled rows are staged beside the target, and counts and outputs read those
    copies, whatever happens to executors; the copies go when the run ends. Once rows are appended
    the log says so, also if the file cannot be archived: that gets a line of its own.
    """
    root = beside(target)
    staged: list[str] = []

    def log(result: LoadResult) -> LoadResult:
        row = [(package_name, run_timestamp, result.rows_inserted, result.rows_rejected, result.status)]
        spark.createDataFrame(row, RUN_LOG).coalesce(1).write.mode("append").parquet(run_log)
        return result

    def stage(df: DataFrame, name: str) -> DataFrame:
        staged.append(scratch_dir(spark, name, root))
        df.write.parquet(staged[-1])
        return spark.read.schema(df.schema).parquet(staged[-1])

    if not path_exists(spark, path):
        return log(LoadResult(NO_FILE, 0, 0, 0))
    try:
        rows = stage(read_inbound_claims(spark, path).withColumn("_row", F.monotonically_increasing_id()), "claims-read")
        classified = stage(key_claims(rows, members, providers), "claims-classified")
        index = IdIndex(spark, f"{target.rstrip('/')}_ids")
        index.recover(spark.read.parquet(target).select("claim_id") if path_exists(spark, target) else None)
        sound = classified.filter(F.col("reject_reason").isNull()).select("conv_claim_id")
        loaded = index.candidates(sound).withColumnRenamed("id", "claim_id")
        settled = settled_claims(stage(settle_claims(rows, classified, loaded, stage).drop("_row"), "claims-settled"))
        fresh = settled.filter(F.col("reject_reason").isNull())
        rejects = settled.filter(F.col("reject_reason").isNotNull())
        counts = settled.agg(F.count("*").alias("rows"), F.count("reject_reason").alias("rejected")).first()
        write_rejects(rejects, reject_path)
        index.begin(fresh.select("conv_claim_id"))
        typed_claims(fresh).withColumn("load_timestamp", F.lit(run_timestamp)).write.mode("append").parquet(target)
        index.finish()
    except Exception:
        log(LoadResult(FAILED, 0, 0, 0))
        raise
    finally:
        for folder in staged:
            remove_dir(spark, folder)
    result = log(LoadResult(SUCCESS, counts.rows, counts.rows - counts.rejected, counts.rejected))
    if archive_dir:
        try:
            archive_file(spark, path, archive_dir, run_timestamp)
        except Exception:
            log(LoadResult(NOT_ARCHIVED, 0, 0, 0))
            raise
    return result


def archive_file(spark: SparkSession, path: str, archive_dir: str, run_timestamp: datetime) -> str:
    """Move a processed file; the run time in the name keeps two runs of one day apart."""
    jvm = spark.sparkContext._jvm
    source = jvm.org.apache.hadoop.fs.Path(path)
    fs = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folder = jvm.org.apache.hadoop.fs.Path(archive_dir)
    fs.mkdirs(folder)
    name = f"{run_timestamp:%Y%m%dT%H%M%S}_{source.getName()}"
    goal = jvm.org.apache.hadoop.fs.Path(folder, name)
    if not fs.rename(source, goal):
        raise RuntimeError(f"could not archive {path}")
    return goal.toString()


# ---------------------------------------------------------------- change jobs

# Allowed codes, return codes and messages of the enrollment and termination jobs.
GENDERS = ("M", "F", "U")
PLAN_TYPES = ("HMO", "PPO", "EPO")
BAD_GENDER = "Invalid gender code. Use M, F, or U."
BAD_PLAN = "Invalid plan type. Use HMO, PPO, or EPO."
TERMINATED = "Provider terminated successfully."
PROVIDER_NOT_FOUND = "Provider not found."
PROVIDER_NOT_FOUND_CODE = 50001
TERMINATION_NOTE = "Provider terminated. Term Date set to "


def enroll_members(
    members: DataFrame, requests: DataFrame, as_of: date, plan_types: Sequence[str] = PLAN_TYPES
) -> tuple[DataFrame, DataFrame]:
    """(new member rows, one outcome per request).

    ``requests`` has a unique ``request_id`` and member_name, date_of_birth, gender, plan_type and
    state. Gender is checked first (-1), then the plan (-2); a NULL passes, as it does in a
    NOT IN test. New ids continue after the highest member id in request order.
    """
    gender, plan = F.trim(F.col("gender")), F.trim(F.col("plan_type"))
    code = F.when(~gender.isin(*GENDERS), -1).when(~plan.isin(*plan_types), -2).otherwise(0)
    checked = requests.withColumn("plan_type", plan).withColumn("return_code", code)
    highest = members.agg(F.coalesce(F.max("member_id"), F.lit(0))).scalar()
    numbered = dense_numbers(checked.filter("return_code = 0"), "request_id", "_n").withColumn(
        "member_id", F.col("_n") + highest
    )
    new_rows = numbered.select(
        "member_id",
        "member_name",
        "date_of_birth",
        "gender",
        "plan_type",
        "state",
        F.lit(as_of).alias("enrollment_date"),
        F.lit(None).cast("date").alias("disenroll_date"),
    )
    accepted = numbered.select("request_id", "return_code", "member_id")
    refused = checked.filter("return_code < 0").select(
        "request_id", "return_code", F.lit(None).cast("bigint").alias("member_id")
    )
    message = F.when(F.col("return_code") == -1, BAD_GENDER).when(F.col("return_code") == -2, BAD_PLAN)
    outcomes = accepted.unionByName(refused).select(
        "request_id", "return_code", F.col("member_id").alias("new_member_id"), message.alias("message")
    )
    return new_rows, outcomes


@dataclass(frozen=True)
class Termination:
    providers: DataFrame
    contracts: DataFrame
    audit: DataFrame
    outcomes: DataFrame


def terminate_providers(
    providers: DataFrame, contracts: DataFrame, requests: DataFrame, changed_at: datetime
) -> Termination:
    """Set term dates and close contracts for ``requests`` (provider_id, term_date, changed_by).

    The frames are new versions of their tables plus the change log; write all of them before
    switching over. An unknown provider changes nothing and gives an error outcome. A contract
    that starts after the term date ends before it starts and is flagged ``ends_before_start``.
    """
    last = latest_rows(requests, ["provider_id"], ["term_date"]).select(
        "provider_id", F.col("term_date").alias("_term"), F.col("changed_by").alias("_by")
    )
    known = providers.select("provider_id").distinct()
    valid = last.join(known, "provider_id", "left_semi")
    new_providers = (
        providers.join(valid.select("provider_id", "_term"), "provider_id", "left")
        .withColumn("term_date", F.coalesce("_term", "term_date"))
        .select(*providers.columns)
    )
    closes = F.col("_term").isNotNull() & (F.col("end_date").isNull() | (F.col("end_date") > F.col("_term")))
    new_contracts = (
        contracts.join(valid.select("provider_id", "_term"), "provider_id", "left")
        .withColumn("end_date", F.when(closes, F.col("_term")).otherwise(F.col("end_date")))
        .withColumn("ends_before_start", F.coalesce(F.col("end_date") < F.col("start_date"), F.lit(False)))
        .select(*contracts.columns, "ends_before_start")
    )
    audit = valid.select(
        F.lit("providers").alias("table_name"),
        F.lit("UPDATE").alias("operation"),
        F.col("provider_id").alias("record_id"),
        F.col("_by").alias("changed_by"),
        F.lit(changed_at).alias("change_date"),
        F.concat(F.lit(TERMINATION_NOTE), F.col("_term").cast("string")).alias("notes"),
    )
    done = valid.select(
        "provider_id", F.lit(0).alias("error_number"), F.lit(TERMINATED).alias("message")
    )
    failed = last.join(known, "provider_id", "left_anti").select(
        "provider_id",
        F.lit(PROVIDER_NOT_FOUND_CODE).alias("error_number"),
        F.lit(PROVIDER_NOT_FOUND).alias("message"),
    )
    return Termination(new_providers, new_contracts, audit, done.unionByName(failed))


ENROLLED = ["member_id", "member_name", "date_of_birth", "gender", "plan_type", "state", "enrollment_date", "disenroll_date"]


def run_enrollment(
    spark: SparkSession, members: str, requests: DataFrame, outcomes: str, as_of: date,
    plan_types: Sequence[str] = PLAN_TYPES, ledger: str | None = None,
) -> None:
    """Enroll ``requests`` into the Parquet table at ``members`` and append one outcome per request.

    Ids are assigned in a ledger (a version store, beside ``members`` unless given) before anything is appended: its
    table ``assigned`` keeps request, outcome and id for good, ``open`` holds the rows whose appends are not known to
    be complete. A run first appends what an earlier one has left open and the tables lack, then assigns ids to requests
    that the ledger does not know. So a run that stops anywhere, and is repeated or followed by another, gives each
    request one outcome and one member. New ids are higher than those of ``members`` and of the ledger.
    """
    ledger = ledger or f"{members.rstrip('/')}_ledger"
    settle_enrollment(spark, members, outcomes, ledger)
    ids = spark.read.parquet(members).select("member_id")
    with versions.change(spark, ledger) as change:
        if "assigned" not in change.tables and path_exists(spark, outcomes):  # answered before there was a ledger
            change.append("assigned", spark.read.parquet(outcomes).select("request_id", "return_code", "new_member_id"))
        if "assigned" in change.tables:
            assigned = change.read("assigned")
            requests = requests.join(assigned.select("request_id"), "request_id", "left_anti")
            ids = ids.unionByName(assigned.select(F.col("new_member_id").alias("member_id")))
        rows, answers = enroll_members(ids, requests, as_of, plan_types)
        change.replace("open", answers.join(rows, F.col("new_member_id") == F.col("member_id"), "left").drop("member_id"))
        change.append("assigned", change.read("open").select("request_id", "return_code", "new_member_id"))
    settle_enrollment(spark, members, outcomes, ledger)


def settle_enrollment(spark: SparkSession, members: str, outcomes: str, ledger: str) -> None:
    """Append the open rows of the ledger that ``members`` and ``outcomes`` lack, then close them."""
    state = versions.latest(spark, ledger)
    if "open" not in state.tables:
        return
    waiting = versions.read(spark, ledger, "open", state)
    if waiting.isEmpty():
        return
    enrolled = waiting.filter("return_code = 0").withColumn("member_id", F.col("new_member_id")).select(*ENROLLED)
    there = spark.read.parquet(members)
    enrolled.join(there.select("member_id"), "member_id", "left_anti").select(*[c for c in ENROLLED if c in there.columns]).write.mode("append").parquet(members)
    answers = waiting.select("request_id", "return_code", "new_member_id", "message")
    if path_exists(spark, outcomes):  # by its schema: a first append that stopped leaves an empty folder
        answered = spark.read.schema(answers.schema).parquet(outcomes).select("request_id")
        answers = answers.join(answered, "request_id", "left_anti")
    answers.write.mode("append").parquet(outcomes)
    with versions.change(spark, ledger) as change:
        change.replace("open", waiting.limit(0))


def run_termination(spark: SparkSession, store: str, requests: DataFrame, changed_at: datetime) -> DataFrame:
    """Apply ``terminate_providers`` to the tables of a version store and log the change; returns the outcomes.

    ``providers``, ``contracts``, ``change_log`` and ``outcomes`` (of this run) are tables of one store, so they switch
    together: a run that stops at any point leaves all of them as they were. A repeated run with the same
    ``changed_at`` changes nothing and logs nothing twice.
    """
    with versions.change(spark, store) as change:
        contracts = change.read("contracts").drop("ends_before_start")
        done = terminate_providers(change.read("providers"), contracts, requests, changed_at)
        log = done.audit
        if "change_log" in change.tables:
            logged = change.read("change_log").select("record_id", "change_date")
            log = log.join(logged, ["record_id", "change_date"], "left_anti").select(*done.audit.columns)
        change.append("change_log", log)
        change.replace("outcomes", done.outcomes)
        change.replace("providers", done.providers)
        change.replace("contracts", done.contracts)
    return versions.read(spark, store, "outcomes")


def backfill_payer(claims: DataFrame, mapping: DataFrame) -> DataFrame:
    """Fill a missing payer from a (member_id, payer_id) table."""
    lookup = mapping.groupBy("member_id").agg(F.min("payer_id").alias("_payer"))
    return (
        claims.join(lookup, "member_id", "left")
        .withColumn("payer_id", F.coalesce("payer_id", "_payer"))
        .select(*claims.columns)
    )


def backfill_load_ts(claims: DataFrame, days: int = 3) -> DataFrame:
    """Fill a missing load time with the service date plus ``days``."""
    guess = F.date_add("service_date", days).cast("timestamp")
    return claims.withColumn("load_timestamp", F.coalesce(F.col("load_timestamp").cast("timestamp"), guess))

