"""X12 834 enrollment files: scan, member loops, rule checks, load control and export.

A file is read as a stream of segments in parallel splits. Nothing gathers a whole file in one
task: running numbers are taken inside a split and shifted by small per-split totals.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from claimspan.functions.measures import is_blank, strip
from claimspan.session import beside, remove_dir, scratch_dir
from claimspan.sources.schemas import ENROLLMENT_FIELDS

# X12 delimiters and the segment ids that open and close a member loop.
SEGMENT_END = "~"
ELEMENT_SEPARATOR = "*"
LOOP_START = "INS"
LOOP_ENDS = ("SE", "GE", "IEA")

# Line-of-business codes and program names.
PROGRAMS = {
    "MCD": "Medicaid",
    "MCR": "Medicare",
    "MKP": "Marketplace",
    "DUL": "Duals",
}

# Severities, outcomes and issue texts of the enrollment checks.
CRITICAL = "CRITICAL"
WARNING = "WARNING"
NONE = "NONE"
LOADED = "LOADED"
REJECTED = "REJECTED"
MISSING_ID_LABEL = "(missing)"
NO_ISSUES = "No issues found."
MEMBER_ID_MISSING = "Member ID is missing."
LOB_UNKNOWN = (
    "Line of Business '%s' does not map to a recognized program "
    "(Medicaid/Medicare/Marketplace/Duals) and cannot be routed."
)
DATE_INVALID = "Coverage effective date '%s' is not a valid date."
PHONE_MISSING = "Phone number is missing."
PLAN_MISSING = "Plan code is missing or ambiguous."
TERM_PAST = "Term date %s is in the past relative to processing date."

AUDIT_FIELDS = ("member_id", "severity", "field", "issue", "outcome")


# ---------------------------------------------------------------- scan and member loops


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, seq, segment_id, elements); line breaks after ``~`` are optional.

    Splits are cut at ``~`` like lines are at newlines. ``seq`` rises inside one split only.
    """
    return (
        spark.read.option("lineSep", SEGMENT_END)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
            strip("value").alias("segment"),
        )
        .filter(F.col("segment") != "")
        .select(
            "file",
            "block",
            "seq",
            F.substring_index("segment", ELEMENT_SEPARATOR, 1).alias("segment_id"),
            F.split("segment", r"\*").alias("elements"),
        )
    )


def _number_groups(segments: DataFrame, start: str, ends: Sequence[str], name: str) -> DataFrame:
    """Number the groups that ``start`` opens; rows outside any open group are dropped.

    A row is inside a group if the last marker so far is a start. Per split that is a running
    maximum of positions; the count of starts and the state at the end of all earlier splits come
    from one row per split.
    """
    is_start = F.col("segment_id") == start
    start_seq = F.when(is_start, F.col("seq"))
    marker_seq = F.when(F.col("segment_id").isin(start, *ends), F.col("seq"))
    per_block = segments.groupBy("block", "file").agg(
        F.count_if(is_start).alias("_starts"), F.max(start_seq).alias("_start"), F.max(marker_seq).alias("_marker")
    )
    open_at_end = F.when(F.col("_marker").isNotNull(), F.col("_start").eqNullSafe(F.col("_marker")))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_block.select(
        "block",
        "file",
        F.coalesce(F.sum("_starts").over(earlier), F.lit(0)).alias("_starts_before"),
        F.coalesce(F.last(open_at_end, ignorenulls=True).over(earlier), F.lit(False)).alias("_open_before"),
    )
    so_far = Window.partitionBy("block", "file").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    open_here = F.when(F.col("_marker").isNull(), F.col("_open_before")).otherwise(
        F.col("_start").eqNullSafe(F.col("_marker"))
    )
    return (
        segments.withColumns(
            {
                "_starts_here": F.count_if(is_start).over(so_far),
                "_start": F.max(start_seq).over(so_far),
                "_marker": F.max(marker_seq).over(so_far),
            }
        )
        .join(carried, ["block", "file"])
        .filter(open_here)
        .withColumn(name, F.col("_starts_before") + F.col("_starts_here"))
        .select(*segments.columns, name)
    )


def member_loops(segments: DataFrame) -> DataFrame:
    """Segments of member loops with their ``loop_no`` inside the file."""
    return _number_groups(segments, LOOP_START, LOOP_ENDS, "loop_no")


def _dashed(raw: Column) -> Column:
    """YYYYMMDD -> YYYY-MM-DD without any check; other lengths pass as they are."""
    dashed = F.concat_ws("-", F.substring(raw, 1, 4), F.substring(raw, 5, 2), F.substring(raw, 7, 2))
    return F.when(F.length(raw) == 8, dashed).otherwise(raw)


def program_name(code: Column) -> Column:
    """Line-of-business code to program name; an unknown code passes as it is."""
    names = F.create_map(*[F.lit(x) for pair in PROGRAMS.items() for x in pair])
    return F.coalesce(F.try_element_at(names, code), code)


def _element(i: int) -> Column:
    return F.coalesce(F.get("elements", F.lit(i)), F.lit(""))


# The segment, qualifier and element each enrollment field comes from.
FIELD_SOURCES = {
    "member_id": ("REF", "0F", 2),
    "line_of_business": ("REF", "17", 2),
    "plan_code": ("REF", "1L", 2),
    "coverage_effective_date": ("DTP", "348", 3),
    "term_date": ("DTP", "349", 3),
    "last_name": ("NM1", None, 3),
    "phone": ("PER", None, 4),
}
FIRST_NAME_ELEMENT = 4


def _field_values(segments: DataFrame) -> DataFrame:
    """Replace ``elements`` by the field a segment sets and its value (names come in one segment)."""
    field, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, (segment, qualifier, i) in FIELD_SOURCES.items():
        here = F.col("segment_id") == segment
        if qualifier:
            here = here & (_element(1) == qualifier)
        field = F.when(here, name).otherwise(field)
        value = F.when(here, _element(i)).otherwise(value)
    first_name = F.when(F.col("segment_id") == "NM1", _element(FIRST_NAME_ELEMENT))
    others = [c for c in segments.columns if c != "elements"]
    return segments.select(
        *others, field.alias("field"), value.alias("value"), first_name.alias("first_name")
    )


def _fold_fields(values: DataFrame) -> DataFrame:
    """One record per loop. The last value of a field wins, even a blank one: its position travels
    with the value, so a loop that crosses a split is folded like any other."""

    def last(name: str) -> Column:
        kept = F.struct("block", "seq", "value", *(["first_name"] if name == "last_name" else []))
        return F.max(F.when(F.col("field") == name, kept)).alias(name)

    folded = values.groupBy("loop_no", "file").agg(*[last(name) for name in FIELD_SOURCES])

    def value(name: str) -> Column:
        return F.coalesce(F.col(f"{name}.value"), F.lit(""))

    return folded.select(
        "file",
        "loop_no",
        value("member_id").alias("member_id"),
        F.coalesce(F.col("last_name.first_name"), F.lit("")).alias("first_name"),
        value("last_name").alias("last_name"),
        program_name(value("line_of_business")).alias("line_of_business"),
        value("plan_code").alias("plan_code"),
        value("phone").alias("phone"),
        _dashed(value("coverage_effective_date")).alias("coverage_effective_date"),
        _dashed(value("term_date")).alias("term_date"),
    )


def parse_members(loops: DataFrame) -> DataFrame:
    """One enrollment record per member loop: eight text fields, "" when absent."""
    return _fold_fields(_field_values(loops))


def parse_834(spark: SparkSession, path: str) -> DataFrame:
    """Files to enrollment records. Only loop markers and field values travel through the shuffle."""
    segments = read_segments(spark, path)
    sources = {segment for segment, _, _ in FIELD_SOURCES.values()}
    needed = segments.filter(F.col("segment_id").isin(LOOP_START, *LOOP_ENDS, *sorted(sources)))
    return _fold_fields(member_loops(_field_values(needed)))


def check_envelope(segments: DataFrame) -> DataFrame:
    """Declared and counted segments per ST...SE transaction."""
    transactions = _number_groups(segments, "ST", ("GE", "IEA", "GS", "ISA"), "transaction_no")
    declared = F.max(F.when(F.col("segment_id") == "SE", F.get("elements", F.lit(1)).try_cast("bigint")))
    return (
        transactions.groupBy("file", "transaction_no")
        .agg(declared.alias("declared_count"), F.count("*").alias("segment_count"))
        .withColumn("matches", F.coalesce(F.col("declared_count") == F.col("segment_count"), F.lit(False)))
    )


# Envelopes from the outside in, with the elements that hold control number and count.
ENVELOPES = (("ISA", 13, "IEA"), ("GS", 6, "GE"), ("ST", 2, "SE"))
TRAILER_CONTROL, TRAILER_COUNT = 2, 1

# Segments in a run, whose headers and trailers are ordered at once.
RUN_BITS = 17

# What can be wrong with an envelope.
UNCLOSED = "unclosed"
UNOPENED = "unopened"
MISMATCH = "control numbers differ"
CROSSED = "closed before its content"
REPEATED = "control number repeated"
MISCOUNTED = "count differs"


def envelope_issues(segments: DataFrame) -> DataFrame:
    """file, envelope, control_number and issue of each fault in the nesting of interchanges, groups and transactions.

    A trailer closes the last header of its kind before it, if that is still open; a header that the next one of its
    kind, or the end of the file, finds open is unclosed. Control numbers are compared between header and trailer, and
    are unique inside the envelope around them; trailers of interchanges and groups tell how many envelopes they hold
    (that of transactions counts segments, see ``check_envelope``).

    Only headers and trailers are ordered: what stands open before a segment comes from a running last value inside its
    run of at most 2 ** RUN_BITS segments, and from one row per run for all runs before it, so an envelope may begin in
    one run or split and end in another, and neither a file nor a split gathers in one sort.
    """
    headers, trailers = [h for h, _, _ in ENVELOPES], [t for _, _, t in ENVELOPES]
    named = F.col("segment_id")
    place = F.lit(TRAILER_CONTROL)
    for header, element, _ in ENVELOPES:
        place = F.when(named == header, F.lit(element)).otherwise(place)
    level = F.coalesce(*[F.when(named.isin(h, t), F.lit(k)) for k, (h, _, t) in enumerate(ENVELOPES)])
    marks = segments.filter(named.isin(*headers, *trailers)).select(
        F.xxhash64("file").alias("code"), "block", F.shiftright("seq", RUN_BITS).alias("run"), "seq", level.alias("level"), named.isin(*headers).alias("opens"),
        F.coalesce(strip(F.get("elements", place)), F.lit("")).alias("control"),
        F.get("elements", F.lit(TRAILER_COUNT)).try_cast("bigint").alias("declared"),
    )
    levels = range(len(ENVELOPES))
    state = F.struct("opens", "control", F.struct("block", "seq").alias("at"))
    of_level = [F.when(F.col("level") == k, state) for k in levels]
    run, place_in_run = Window.partitionBy("code", "block", "run"), F.col("seq")
    marks_so_far = run.orderBy(place_in_run).rowsBetween(Window.unboundedPreceding, 0)
    marks_before = run.orderBy(place_in_run).rowsBetween(Window.unboundedPreceding, -1)
    # The last mark of each kind in a run, which its last row knows, and in all runs before one.
    known = marks.select(
        "code", "block", "run", *[F.last(c, ignorenulls=True).over(marks_so_far).alias(f"last{k}") for k, c in enumerate(of_level)],
        F.lead("seq").over(run.orderBy(place_in_run)).alias("next"),
    )
    per_run = known.filter(F.col("next").isNull()).drop("next")
    runs_before = Window.partitionBy("code").orderBy("block", "run").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_run.select("code", "block", "run", *[F.last(f"last{k}", ignorenulls=True).over(runs_before).alias(f"carried{k}") for k in levels])
    here = [F.last(c, ignorenulls=True).over(marks_before).alias(f"here{k}") for k, c in enumerate(of_level)]
    seen = marks.select("*", *here).join(carried, ["code", "block", "run"]).select(
        *marks.columns, *[F.coalesce(f"here{k}", f"carried{k}").alias(f"before{k}") for k in levels]
    )

    def by_level(pick) -> Column:
        return F.coalesce(*[F.when(F.col("level") == k, pick(k)) for k in levels])

    own = by_level(lambda k: F.col(f"before{k}"))
    inner = F.coalesce(F.when(F.col("level") == 0, F.col("before1")), F.when(F.col("level") == 1, F.col("before2")))
    outer = F.coalesce(F.when(F.col("level") == 1, F.col("before0")), F.when(F.col("level") == 2, F.col("before1")))
    seen = seen.select("code", "level", "opens", "control", "declared", F.struct("block", "seq").alias("at"),
                       own.alias("own"), inner.alias("inner"), F.when(outer["opens"], outer["at"]).alias("parent"))
    open_own = F.coalesce(F.col("own.opens"), F.lit(False))
    name = F.element_at(F.array(*[F.lit(h) for h in headers]), F.col("level") + 1).alias("envelope")

    def issue(condition: Column, control: str, text: str) -> Column:
        return F.when(condition, F.struct(F.col(control).alias("control_number"), F.lit(text).alias("issue")))

    def found(rows: DataFrame, *issues: Column) -> DataFrame:
        each = rows.select("code", name, F.explode(F.array_compact(F.array(*issues))).alias("found"))
        return each.select("code", "envelope", "found.*")

    closes = ~F.col("opens")
    children = seen.filter(F.col("opens") & F.col("parent").isNotNull()).groupBy("code", (F.col("level") - 1).alias("level"), F.col("parent").alias("header"))
    closed = seen.filter(closes & open_own & (F.col("level") < len(ENVELOPES) - 1)).withColumn("header", F.col("own.at"))
    counted = closed.join(children.agg(F.count("*").alias("held")), ["code", "level", "header"], "left")
    repeated = seen.filter("opens").groupBy("code", "level", "parent", "control").agg(F.count("*").alias("n"))
    lasts = [F.struct(F.lit(k).alias("level"), F.col(f"last{k}").alias("own")) for k in levels]
    lasts = per_run.select("code", F.explode(F.array(*lasts)).alias("mark")).select("code", "mark.*").filter(F.col("own").isNotNull())
    at_end = lasts.groupBy("code", "level").agg(F.max_by("own", F.col("own.at")).alias("own"))
    issues = [
        found(
            seen,
            issue(F.col("opens") & open_own, "own.control", UNCLOSED),
            issue(closes & ~open_own, "control", UNOPENED),
            issue(closes & open_own & (F.col("own.control") != F.col("control")), "own.control", MISMATCH),
            issue(closes & open_own & F.col("inner.opens") & (F.col("inner.at") > F.col("own.at")), "own.control", CROSSED),
        ),
        found(at_end, issue(open_own, "own.control", UNCLOSED)),
        found(repeated, issue(F.col("n") > 1, "control", REPEATED)),
        found(counted, issue(~F.col("declared").eqNullSafe(F.coalesce("held", F.lit(0))), "own.control", MISCOUNTED)),
    ]
    # Rows carry a code of their file, as its path would be most of each; files are named at the end.
    files = segments.select("file").distinct().withColumn("code", F.xxhash64("file"))
    return reduce(DataFrame.unionByName, issues).join(F.broadcast(files), "code").select("file", "envelope", "control_number", "issue")


# ---------------------------------------------------------------- rule checks and load control


def _text(pattern: str, value: Column) -> Column:
    return F.format_string(pattern, value)


def validate(records: DataFrame, as_of: date) -> DataFrame:
    """Add ``issues``: (severity, field, message) in rule order."""
    effective = F.try_to_date("coverage_effective_date", "yyyy-MM-dd")
    term = F.try_to_date("term_date", "yyyy-MM-dd")
    lob = F.col("line_of_business")
    rules: list[tuple[Column, str, str, Column]] = [
        (is_blank("member_id"), CRITICAL, "member_id", F.lit(MEMBER_ID_MISSING)),
        (
            ~F.coalesce(lob.isin(*PROGRAMS.values()), F.lit(False)),
            CRITICAL,
            "line_of_business",
            _text(LOB_UNKNOWN, F.coalesce(lob, F.lit(""))),
        ),
        (
            effective.isNull(),
            CRITICAL,
            "coverage_effective_date",
            _text(DATE_INVALID, F.coalesce("coverage_effective_date", F.lit(""))),
        ),
        (is_blank("phone"), WARNING, "phone", F.lit(PHONE_MISSING)),
        (is_blank("plan_code"), WARNING, "plan_code", F.lit(PLAN_MISSING)),
        (term < F.lit(as_of), WARNING, "term_date", _text(TERM_PAST, term.cast("string"))),
    ]
    issues = [
        F.when(broken, F.struct(F.lit(severity).alias("severity"), F.lit(field).alias("field"), message.alias("issue")))
        for broken, severity, field, message in rules
    ]
    return records.withColumn("issues", F.array_compact(F.array(*issues)))


def decide(validated: DataFrame) -> DataFrame:
    """Add load_status and flagged_for_review: any CRITICAL rejects, a WARNING alone flags."""

    def has(severity: str) -> Column:
        return F.exists("issues", lambda i: i["severity"] == severity)

    return validated.withColumn(
        "load_status", F.when(has(CRITICAL), REJECTED).otherwise(LOADED)
    ).withColumn("flagged_for_review", F.when(~has(CRITICAL) & has(WARNING), "YES").otherwise("NO"))


def route(decided: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(loaded, rejected) records without the issue list."""
    records = decided.drop("issues")
    return records.filter(F.col("load_status") == LOADED), records.filter(F.col("load_status") == REJECTED)


def audit_log(decided: DataFrame) -> DataFrame:
    """One row per issue, or one NONE row for a clean record."""
    clean = F.array(F.struct(F.lit(NONE).alias("severity"), F.lit("").alias("field"), F.lit(NO_ISSUES).alias("issue")))
    shown = F.when(F.coalesce(F.col("member_id"), F.lit("")) == "", MISSING_ID_LABEL).otherwise(F.col("member_id"))
    return decided.select(
        shown.alias("member_id"),
        F.inline(F.when(F.size("issues") > 0, F.col("issues")).otherwise(clean)),
        F.col("load_status").alias("outcome"),
    ).select(*AUDIT_FIELDS)


def summary(decided: DataFrame) -> DataFrame:
    """Batch counts in one aggregation."""

    def empty(field: str) -> Column:
        return F.count_if(F.coalesce(F.col(field), F.lit("")) == "")

    return decided.agg(
        F.count("*").alias("total_records"),
        F.count_if(F.col("load_status") == LOADED).alias("loaded"),
        F.count_if(F.col("flagged_for_review") == "YES").alias("flagged"),
        F.count_if(F.col("load_status") == REJECTED).alias("rejected"),
        F.coalesce(F.sum(F.greatest(F.size("issues"), F.lit(1))), F.lit(0)).cast("bigint").alias("audit_rows"),
        empty("member_id").alias("missing_member_id"),
        empty("plan_code").alias("missing_plan_code"),
        empty("phone").alias("missing_phone"),
    )


def write_outputs(decided: DataFrame, folder: str) -> dict[str, str]:
    """Loaded, rejected and audit CSV folders with header, replacing the previous run.

    The decided records are staged beside the outputs first, so the input is parsed once and the three
    outputs describe the same records; the staged copy goes at the end.
    """
    spark = decided.sparkSession
    staged = scratch_dir(spark, "enrollment", f"{folder.rstrip('/')}/_staging")
    try:
        decided.write.parquet(staged)
        decided = spark.read.parquet(staged)
        loaded, rejected = route(decided)
        columns = [*ENROLLMENT_FIELDS, "load_status", "flagged_for_review"]
        outputs = {
            "enrollment_loaded": loaded.select(*columns),
            "enrollment_rejected": rejected.select(*columns),
            "audit_log": audit_log(decided),
        }
        paths = {name: f"{folder.rstrip('/')}/{name}" for name in outputs}
        for name, df in outputs.items():
            df.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(paths[name])
    finally:
        remove_dir(spark, staged)
    return paths


# ---------------------------------------------------------------- export


#: Member values that go into segments.
EXPORT_FIELDS = (*ENROLLMENT_FIELDS, "maintenance_type", "street", "city", "state", "zip")


def delimiter_reason(members: DataFrame) -> Column:
    """Which fields hold an X12 delimiter, or NULL; such a value would shift the elements behind it."""
    held = [F.when(F.col(c).cast("string").rlike("[*~]"), F.lit(c)) for c in EXPORT_FIELDS if c in members.columns]
    names = F.concat_ws(", ", *held)
    return F.when(names != "", F.concat(names, F.lit(" holds an X12 delimiter")))


def member_segments(members: DataFrame) -> DataFrame:
    """Add ``segments``: the member's segments in file order; an absent field leaves its segment out.

    Besides the enrollment fields, ``maintenance_type``, ``street``, ``city``, ``state`` and
    ``zip`` are used when the frame has them. A value that holds a delimiter stops the export,
    because it would shift the elements behind it.
    """

    def field(name: str, default: str = "") -> Column:
        if name not in members.columns:
            return F.lit(default)
        stop = F.raise_error(F.concat(F.lit(f"{name} holds an X12 delimiter: "), F.col(name))).cast("string")
        return F.when(F.col(name).rlike("[*~]"), stop).otherwise(F.coalesce(F.col(name), F.lit(default)))

    def segment(*elements: Column | str) -> Column:
        return F.concat_ws(ELEMENT_SEPARATOR, *[e if isinstance(e, Column) else F.lit(e) for e in elements])

    def given(name: str, *elements: Column | str) -> Column:
        return F.when(field(name) != "", segment(*elements))

    def compact(name: str) -> Column:
        iso = field(name).rlike(r"^\d{4}-\d{2}-\d{2}$")
        return F.when(iso, F.replace(field(name), F.lit("-"), F.lit(""))).otherwise(field(name))

    codes = F.create_map(*[F.lit(x) for code, name in PROGRAMS.items() for x in (name, code)])
    lob = F.coalesce(F.try_element_at(codes, field("line_of_business")), field("line_of_business"))
    known = F.when(field("member_id") != "", F.lit("ZZ")).otherwise(F.lit(""))
    plan = F.when(field("plan_code") != "", field("plan_code")).otherwise(F.lit("UNSPECIFIED"))
    return members.withColumn(
        "segments",
        F.array_compact(
            F.array(
                segment("INS", "Y", "18", field("maintenance_type", "030"), "XN", "A", "E", "N"),
                given("member_id", "REF", "0F", field("member_id")),
                segment("REF", "17", lob),
                given("plan_code", "REF", "1L", field("plan_code")),
                given("coverage_effective_date", "DTP", "348", "D8", compact("coverage_effective_date")),
                given("term_date", "DTP", "349", "D8", compact("term_date")),
                segment(
                    "NM1", "IL", "1", field("last_name"), field("first_name"), "", "", "", known, field("member_id")
                ),
                given("street", "N3", field("street")),
                given("city", "N4", field("city"), field("state"), field("zip")),
                given("phone", "PER", "IP", "", "TE", field("phone")),
                segment("HD", "030", "", "HLT", plan),
            )
        ),
    )


#: What the envelope names; a caller passes its own trading partners.
PARTNER_KEYS = ("sender", "receiver", "payer", "payer_id", "sponsor", "sponsor_id")

#: ST, BGN, two N1 and SE belong to every transaction beside the member segments.
ENVELOPE_SEGMENTS = 5


def write_834(
    members: DataFrame,
    path: str,
    order_by: Sequence[str],
    partners: Mapping[str, str],
    created: datetime,
    control_number: int = 1,
    files: int | None = None,
    members_per_file: int = 250_000,
    rejects: str | None = None,
) -> None:
    """Write members as complete 834 interchanges, one text file each.

    ``partners`` has the values of PARTNER_KEYS. Without ``files`` their number follows from
    ``members_per_file``. Members are dealt out evenly and staged once beside ``path``; each file gets
    its own envelope, control number and SE count, so files can be written and later read in parallel.
    A member with a delimiter in a value stops the export; with ``rejects`` such members are written to
    that Parquet folder with a ``reject_reason`` instead, and all others are exported.
    """
    missing = [k for k in PARTNER_KEYS if k not in partners]
    if missing:
        raise ValueError(f"partners lacks {', '.join(missing)}")
    spark = members.sparkSession
    if rejects:
        reason = delimiter_reason(members)
        marked = members.withColumn("reject_reason", reason)
        marked.filter(F.col("reject_reason").isNotNull()).write.mode("overwrite").parquet(rejects)
        members = members.filter(reason.isNull())
    if files is None:
        files = max(1, -(-members.count() // members_per_file))
    staged_path = scratch_dir(spark, "export-834", beside(path))
    try:
        (
            member_segments(members)
            .repartition(files)
            .select(
                F.spark_partition_id().alias("file_no"),
                F.struct(*order_by).alias("position"),
                F.size("segments").alias("n"),
                F.array_join("segments", f"{SEGMENT_END}\n").alias("value"),
            )
            .write.parquet(staged_path)
        )
        body = spark.read.parquet(staged_path)
        # File 0 exists even for an empty batch, as a valid interchange without members.
        first = spark.range(1).select(F.lit(0).alias("file_no"), F.lit(0).alias("n"))
        counts = body.select("file_no", "n").unionByName(first).groupBy("file_no").agg(F.sum("n").alias("n"))

        control = F.lpad((F.col("file_no") + control_number).cast("string"), 9, "0")
        day, time = f"{created:%Y%m%d}", f"{created:%H%M}"

        def segment(*elements: Column | str) -> Column:
            return F.concat_ws(ELEMENT_SEPARATOR, *[e if isinstance(e, Column) else F.lit(e) for e in elements])

        pad = " " * 10
        header = F.array_join(
            F.array(
                segment(
                    "ISA", "00", pad, "00", pad, "ZZ", partners["sender"].ljust(15), "ZZ", partners["receiver"].ljust(15),
                    f"{created:%y%m%d}", time, "^", "00501", control, "0", "P", ":",
                ),
                segment("GS", "BE", partners["sender"], partners["receiver"], day, time, "1", "X", "005010X220A1"),
                segment("ST", "834", "0001"),
                segment("BGN", "00", control, day, time, "", "", "", "4"),
                segment("N1", "P5", partners["payer"], "FI", partners["payer_id"]),
                segment("N1", "IN", partners["sponsor"], "FI", partners["sponsor_id"]),
            ),
            f"{SEGMENT_END}\n",
        )
        trailer = F.array_join(
            F.array(
                segment("SE", (F.col("n") + ENVELOPE_SEGMENTS).cast("string"), "0001"),
                segment("GE", "1", "1"),
                segment("IEA", "1", control),
            ),
            f"{SEGMENT_END}\n",
        )
        no_position = F.lit(None).cast(body.schema["position"].dataType)
        parts = [
            counts.select("file_no", F.lit(0).alias("part"), no_position.alias("position"), header.alias("value")),
            body.select("file_no", F.lit(1).alias("part"), "position", "value"),
            counts.select("file_no", F.lit(2).alias("part"), no_position.alias("position"), trailer.alias("value")),
        ]
        rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
        (
            rows.repartitionByRange(files, "file_no")
            .sortWithinPartitions("file_no", "part", "position")
            .select("file_no", "value")
            .write.mode("overwrite")
            .partitionBy("file_no")
            .option("lineSep", f"{SEGMENT_END}\n")
            .text(path)
        )
    finally:
        remove_dir(spark, staged_path)
