"""Nested envelopes against a plain reading, with splits that cut them anywhere."""

from collections import Counter
import random

import pytest

from claimspan.operators import edi

PLACE = {h: e for h, e, _ in edi.ENVELOPES}
KINDS = {h: (k, True) for k, (h, _, _) in enumerate(edi.ENVELOPES)} | {t: (k, False) for k, (_, _, t) in enumerate(edi.ENVELOPES)}
NAMES = [h for h, _, _ in edi.ENVELOPES]


def brute(segments):
    last, out, numbers, held = [None] * 3, Counter(), Counter(), Counter()
    closings = []
    for at, elements in enumerate(segments):
        if elements[0] not in KINDS:
            continue
        k, opens = KINDS[elements[0]]
        place = PLACE.get(elements[0], edi.TRAILER_CONTROL)
        control = elements[place] if len(elements) > place else ""
        before = last[k] if last[k] and last[k][0] else None
        if opens:
            if before:
                out[NAMES[k], before[1], edi.UNCLOSED] += 1
            around = last[k - 1][2] if k and last[k - 1] and last[k - 1][0] else None
            numbers[k, around, control] += 1
            if around is not None:
                held[k - 1, around] += 1
        elif not before:
            out[NAMES[k], control, edi.UNOPENED] += 1
        else:
            if before[1] != control:
                out[NAMES[k], before[1], edi.MISMATCH] += 1
            if k < 2:
                inner = last[k + 1]
                if inner and inner[0] and inner[2] > before[2]:
                    out[NAMES[k], before[1], edi.CROSSED] += 1
                closings.append((k, before, elements[1] if len(elements) > 1 else None))
        last[k] = (opens, control, at)
    for k, mark in enumerate(last):
        if mark and mark[0]:
            out[NAMES[k], mark[1], edi.UNCLOSED] += 1
    for (k, _, control), n in numbers.items():
        if n > 1:
            out[NAMES[k], control, edi.REPEATED] += 1
    for k, header, count in closings:
        if not (count or "").isdigit() or int(count) != held[k, header[2]]:
            out[NAMES[k], header[1], edi.MISCOUNTED] += 1
    return out


def random_segments(rng, n):
    out = []
    for _ in range(n):
        kind = rng.choice([*KINDS, "INS", "REF", "ST", "SE", "GS", "GE"])
        control = str(rng.randrange(4))
        if kind in PLACE:
            out.append([kind, *["0"] * (PLACE[kind] - 1), control])
        elif kind in KINDS:
            out.append([kind, rng.choice(["0", "1", "1", "2", "x"]), control][: rng.choice([2, 3, 3, 3, 3])])
        else:
            out.append([kind, "text"])
    return out


@pytest.mark.parametrize("split", ["40", "100000"])
def test_issues_equal_a_plain_reading(spark, tmp_path, conf, split):
    conf(spark__sql__files__maxPartitionBytes=split, spark__sql__files__openCostInBytes="1")
    rng, expected = random.Random(6), Counter()
    for k in range(6):
        segments = random_segments(rng, [0, 1, 40, 150, 150, 300][k])
        (tmp_path / f"f{k}.834").write_text("~\n".join("*".join(s) for s in segments) + "~\n")
        expected.update({(f"f{k}.834", *issue): n for issue, n in brute(segments).items()})
    read = edi.read_segments(spark, str(tmp_path))
    got = Counter((r.file.rsplit("/", 1)[1], r.envelope, r.control_number, r.issue) for r in edi.envelope_issues(read).collect())
    assert got == expected and len({issue for *_, issue in got}) == 6
    if split == "40":
        assert read.rdd.getNumPartitions() > 20


@pytest.mark.parametrize("bits", [0, 3])
def test_no_sort_holds_more_than_a_run_of_a_split(spark, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(edi, "RUN_BITS", bits)
    segments = random_segments(random.Random(9), 400)
    (tmp_path / "f.834").write_text("~\n".join("*".join(s) for s in segments) + "~\n")
    issues = edi.envelope_issues(edi.read_segments(spark, str(tmp_path))).drop("file")
    assert Counter(tuple(r) for r in issues.collect()) == brute(segments)
    plan = issues._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "seq" in line]
    assert windows and all("run#" in line for line in windows)
