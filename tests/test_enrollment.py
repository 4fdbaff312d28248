"""834 files: scan, loops, fields, rules, load control, export."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from claimspan.operators import edi
from claimspan.sources.schemas import ENROLLMENT_FIELDS

AS_OF = date(2026, 8, 8)
CREATED = datetime(2026, 8, 8, 10, 15)
PARTNERS = {"sender": "A", "receiver": "B", "payer": "C", "payer_id": "1", "sponsor": "D", "sponsor_id": "2"}

ENVELOPE = "ISA*00*x~GS*BE*A*B~ST*834*0001~BGN*00*1~N1*P5*PLAN~"


def write(tmp_path, text, name="in.834"):
    path = tmp_path / name
    path.write_text(text, newline="")
    return str(path)


def parse(spark, path):
    records = edi.parse_834(spark, path).orderBy("file", "loop_no")
    return [{f: r[f] for f in ENROLLMENT_FIELDS} for r in records.collect()]


def record(**given):
    return {**{f: "" for f in ENROLLMENT_FIELDS}, **given}


CLEAN = record(
    member_id="M1", first_name="ANA", last_name="DIAZ", line_of_business="Medicaid", plan_code="P1",
    phone="7135550000", coverage_effective_date="2026-01-01", term_date="2027-01-01",
)


def issues(spark, **changes):
    df = spark.createDataFrame([{**CLEAN, **changes}], ", ".join(f"{f} string" for f in ENROLLMENT_FIELDS))
    row = edi.decide(edi.validate(df, AS_OF)).first()
    return [(i.severity, i.field) for i in row.issues], row.load_status, row.flagged_for_review


@pytest.mark.parametrize("break_", ["", "\n", "\r\n"])
def test_line_breaks_are_optional(spark, tmp_path, break_):
    text = (ENVELOPE + "INS*Y~REF*0F*M1~NM1*IL*1*DIAZ*ANA****ZZ*M1~INS*Y~REF*0F*M2~SE*9*0001~GE*1*1~IEA*1*1~").replace(
        "~", "~" + break_
    )
    assert parse(spark, write(tmp_path, text)) == [
        record(member_id="M1", first_name="ANA", last_name="DIAZ"),
        record(member_id="M2"),
    ]


def test_fields_and_defaults(spark, tmp_path):
    text = (
        ENVELOPE
        + "INS*Y~REF*17*MCD~DTP*348*D8*20261345~DTP*349*D8*2027~NM1*IL*1*DOE~PER*IP**TE~"  # short segments
        + "INS*Y~REF*0F*M2~REF*17*ZZZ~REF*1L*PPO~DTP*348*D8*20260101~PER*IP**TE*7130001111~"
        + "INS*Y~REF*0F*M3~REF*0F*~NM1*IL*1*FIRST*LAST~NM1*IL*1**~"  # the last one wins, even blank
        + "SE*1*0001~REF*0F*LATE~INS*Y~REF*0F*M4~"  # outside a loop; then a loop without trailer
    )
    assert parse(spark, write(tmp_path, text)) == [
        record(line_of_business="Medicaid", coverage_effective_date="2026-13-45", term_date="2027", last_name="DOE"),
        record(
            member_id="M2", line_of_business="ZZZ", plan_code="PPO", coverage_effective_date="2026-01-01",
            phone="7130001111",
        ),
        record(),
        record(member_id="M4"),
    ]


def test_two_transactions_and_two_files(spark, tmp_path):
    one = "ST*834*1~BGN*00~INS*Y~REF*0F*A~SE*5*1~ST*834*2~INS*Y~REF*0F*B~REF*17*DUL~SE*9*2~GE*2~"
    write(tmp_path, one, "a.834")
    write(tmp_path, "ST*834*1~INS*Y~REF*0F*C~SE*4*1~", "b.834")
    assert [r["member_id"] for r in parse(spark, str(tmp_path))] == ["A", "B", "C"]
    envelope = edi.check_envelope(edi.read_segments(spark, str(tmp_path))).orderBy("file", "transaction_no").collect()
    assert [(r.declared_count, r.segment_count, r.matches) for r in envelope] == [
        (5, 5, True), (9, 5, False), (4, 4, True),
    ]


def test_many_splits_give_the_same_members(spark, tmp_path, conf):
    names = [f"M{i}" for i in range(400)]
    body = "".join(f"INS*Y~REF*0F*{n}~NM1*IL*1*L{n}*F{n}~DTP*348*D8*20260101~" for n in names)
    path = write(tmp_path, ENVELOPE + body + "SE*1603*0001~GE*1~IEA*1~INS*Y~REF*0F*TAIL~")
    whole = parse(spark, path)
    conf(spark__sql__files__maxPartitionBytes="700", spark__sql__files__openCostInBytes="1")
    segments = edi.read_segments(spark, path)
    assert segments.select("block").distinct().count() > 10
    assert parse(spark, path) == whole
    assert [r["member_id"] for r in whole] == names + ["TAIL"]
    loops = edi.member_loops(segments).groupBy("loop_no").agg(F.count("*").alias("n")).collect()
    assert sorted((r.loop_no, r.n) for r in loops) == [(i + 1, 4) for i in range(400)] + [(401, 2)]
    assert [r.matches for r in edi.check_envelope(segments).collect()] == [False]


def test_clean_record(spark):
    assert issues(spark) == ([], "LOADED", "NO")


@pytest.mark.parametrize(
    "changes, expected",
    [
        ({"member_id": "  "}, ([("CRITICAL", "member_id")], "REJECTED", "NO")),
        ({"line_of_business": ""}, ([("CRITICAL", "line_of_business")], "REJECTED", "NO")),
        ({"coverage_effective_date": "2026-13-45"}, ([("CRITICAL", "coverage_effective_date")], "REJECTED", "NO")),
        ({"coverage_effective_date": "20260101"}, ([("CRITICAL", "coverage_effective_date")], "REJECTED", "NO")),
        ({"phone": " "}, ([("WARNING", "phone")], "LOADED", "YES")),
        ({"plan_code": ""}, ([("WARNING", "plan_code")], "LOADED", "YES")),
        ({"term_date": "2026-08-07"}, ([("WARNING", "term_date")], "LOADED", "YES")),
        ({"term_date": "2026-08-08"}, ([], "LOADED", "NO")),
        ({"term_date": "soon"}, ([], "LOADED", "NO")),
        (
            {"member_id": "", "plan_code": ""},
            ([("CRITICAL", "member_id"), ("WARNING", "plan_code")], "REJECTED", "NO"),
        ),
    ],
)
def test_rules(spark, changes, expected):
    assert issues(spark, **changes) == expected


def test_audit_rows_and_summary(spark):
    rows = [CLEAN, {**CLEAN, "member_id": "", "phone": ""}, {**CLEAN, "member_id": " "}, {**CLEAN, "line_of_business": "X"}]
    df = spark.createDataFrame(rows, ", ".join(f"{f} string" for f in ENROLLMENT_FIELDS))
    decided = edi.decide(edi.validate(df, AS_OF))
    audit = sorted(tuple(r) for r in edi.audit_log(decided).collect())
    assert audit == sorted(
        [
            ("M1", "NONE", "", "No issues found.", "LOADED"),
            ("(missing)", "CRITICAL", "member_id", "Member ID is missing.", "REJECTED"),
            ("(missing)", "WARNING", "phone", "Phone number is missing.", "REJECTED"),
            (" ", "CRITICAL", "member_id", "Member ID is missing.", "REJECTED"),
            (
                "M1", "CRITICAL", "line_of_business",
                "Line of Business 'X' does not map to a recognized program "
                "(Medicaid/Medicare/Marketplace/Duals) and cannot be routed.",
                "REJECTED",
            ),
        ]
    )
    s = edi.summary(decided).first()
    assert (s.total_records, s.loaded, s.flagged, s.rejected, s.audit_rows) == (4, 1, 0, 3, 5)
    assert (s.missing_member_id, s.missing_plan_code, s.missing_phone) == (1, 0, 1)
    loaded, rejected = edi.route(decided)
    assert loaded.count() + rejected.count() == 4


def test_export_is_one_valid_file_in_order(spark, tmp_path):
    rows = [{**CLEAN, "member_id": f"M{i}", "last_name": f"N{i:02}", "phone": "" if i % 2 else "1"} for i in range(20)]
    rows[3]["member_id"] = ""
    rows[4]["line_of_business"] = "Unspecified"
    rows[5]["coverage_effective_date"] = "2026-13-45"
    df = spark.createDataFrame(rows, ", ".join(f"{f} string" for f in ENROLLMENT_FIELDS))
    df = df.withColumn("street", F.lit("1 MAIN ST")).withColumn("city", F.lit("X")).withColumn("state", F.lit("TX"))
    path = str(tmp_path / "out")
    edi.write_834(df.withColumn("zip", F.lit("77001")), path, ["last_name"], PARTNERS, CREATED)
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").rglob("part-*")))
    segments = [s.strip().split("*") for s in text.split("~") if s.strip()]
    assert [s[0] for s in segments[:7]] == ["ISA", "GS", "ST", "BGN", "N1", "N1", "INS"]
    assert [s[0] for s in segments[-3:]] == ["SE", "GE", "IEA"]
    assert int(segments[-3][1]) == len(segments) - 4  # without ISA, GS, GE and IEA
    assert [s[3] for s in segments if s[0] == "NM1"] == [r["last_name"] for r in rows]
    assert [s for s in segments if s[0] == "N4"][0] == ["N4", "X", "TX", "77001"]
    assert parse(spark, path) == rows


@pytest.mark.parametrize("files", [None, 3])
def test_export_in_several_files_and_of_nothing(spark, tmp_path, files):
    rows = [{**CLEAN, "member_id": f"M{i % 3}"} for i in range(30)]  # copies
    schema = ", ".join(f"{f} string" for f in ENROLLMENT_FIELDS)
    path = str(tmp_path / "out")
    edi.write_834(spark.createDataFrame(rows, schema), path, ["member_id"], PARTNERS, CREATED, files=files, members_per_file=7)
    envelope = edi.check_envelope(edi.read_segments(spark, path)).collect()
    assert len(envelope) == (files or 5) and all(r.matches for r in envelope)
    assert sorted(r["member_id"] for r in parse(spark, path)) == sorted(r["member_id"] for r in rows)
    empty = str(tmp_path / "empty")
    edi.write_834(spark.createDataFrame([], schema), empty, ["member_id"], PARTNERS, CREATED, files=files)
    assert parse(spark, empty) == []
    assert [r.matches for r in edi.check_envelope(edi.read_segments(spark, empty)).collect()][:1] == [True]


def test_written_outputs(spark, tmp_path):
    rows = [CLEAN, {**CLEAN, "phone": ""}, {**CLEAN, "member_id": ""}]
    df = spark.createDataFrame(rows, ", ".join(f"{f} string" for f in ENROLLMENT_FIELDS))
    decided = edi.decide(edi.validate(df, AS_OF))
    for _ in range(2):  # a second run replaces the first
        paths = edi.write_outputs(decided, str(tmp_path))
    counts = {name: spark.read.option("header", True).csv(p).count() for name, p in paths.items()}
    assert counts == {"enrollment_loaded": 2, "enrollment_rejected": 1, "audit_log": 3}


@pytest.mark.parametrize("value", ["A*B", "A~B"])
def test_export_refuses_delimiters_in_values(spark, tmp_path, value):
    df = spark.createDataFrame([{**CLEAN, "last_name": value}], ", ".join(f"{f} string" for f in ENROLLMENT_FIELDS))
    with pytest.raises(Exception, match="last_name holds an X12 delimiter"):
        edi.write_834(df, str(tmp_path / "out"), ["member_id"], PARTNERS, CREATED)
