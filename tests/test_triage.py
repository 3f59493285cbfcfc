"""Verdicts, seconds and windows against a plain restatement of the rules."""

import math
import random

import pytest

from benthos.operators import triage

SCHEMA = "name string, dim_t long, frame_difference double, std_intensity double, detection_count double, moving_object_count double, detection_top_class string, detection_confidence double, fps double, obs_level int"


def frame(spark, lines, fps=10.0, step=10):
    rows = [(n, i * step, float(m) if m is not None else None, s, d, v, c, None, fps, 1) for n, line in lines.items() for i, (m, s, d, v, c) in enumerate(line)]
    return triage.verdicts(triage.timeline(spark.createDataFrame(rows, SCHEMA)))


def rank(values, p):
    v = sorted(values)
    return v[min(len(v) - 1, int(p * len(v)))] if v else 0.0


def plain_verdicts(line):
    line = [r for r in line if r[0] is not None and math.isfinite(r[0])]
    low, high, detail = rank([m for m, *_ in line if m >= 0.01], 0.15), rank([m for m, *_ in line], 0.9), rank([s for _, s, *_ in line if s is not None], 0.5)
    out = []
    for m, s, d, v, _ in line:
        if m < 0.01:
            out.append("frozen")
        elif d:
            out.append("subject")
        elif v:
            out.append("unnamed")
        elif m <= low:
            out.append("empty" if detail > 0 and s is not None and s < 0.2 * detail else "dwell")
        else:
            out.append("active" if m >= high else None)
    return out


def plain_windows(kinds, labels):
    runs = []
    for i, (k, lab) in enumerate(zip(kinds, labels)):
        if k is None:
            continue
        if runs and runs[-1][:2] == [k, lab] and runs[-1][3] == i - 1:
            runs[-1][3] = i
        else:
            runs.append([k, lab, i, i])
    kept = []
    for k, lab, s, e in runs:
        for old in reversed(kept):
            if s - old[3] - 1 > 10:
                kept.append([k, lab, s, e])
                break
            if old[:2] == [k, lab]:
                old[3] = max(old[3], e)
                break
        else:
            kept.append([k, lab, s, e])
    return sorted((k, lab or "", s, e) for k, lab, s, e in kept if k == "subject" or e > s)


def random_line(rng):
    n = rng.randint(2, 70)
    return [(rng.choice([0.0, 0.005, rng.random(), rng.random() * 9]), rng.choice([None, 0.1, 5.0]), float(rng.random() < 0.3), float(rng.random() < 0.1), rng.choice(["a", "b", None])) for _ in range(n)]


def test_verdicts_and_windows_on_random_timelines(spark):
    rng = random.Random(1)
    lines = {f"r{i}": random_line(rng) for i in range(120)}
    judged = frame(spark, lines)
    got, wins = {}, {}
    for r in judged.orderBy("name", "t").collect():
        got.setdefault(r["name"], []).append(r["verdict"])
    for r in triage.windows(judged).collect():
        wins.setdefault(r["name"], []).append((r["kind"], r["label"] or "", r["s"], r["e"]))
    for name, line in lines.items():
        want = plain_verdicts(line)
        assert got[name] == want
        labels = [(c or "") if k == "subject" else None for k, (*_, c) in zip(want, line)]
        assert sorted(wins.get(name, [])) == plain_windows(want, labels)


def test_a_run_that_was_extended_hides_older_ones(spark):
    a, b, none = (1.0, 5.0, 1.0, 0.0, "A"), (1.0, 5.0, 1.0, 0.0, "B"), (1.0, 5.0, 0.0, 0.0, None)
    line = [a] * 6 + [b] + [a] * 9 + [none] * 2 + [a] * 2
    j = frame(spark, {"r": line}).where("detections > 0 or true")
    wins = sorted((r["label"], r["s"], r["e"]) for r in triage.windows(j).where("kind = 'subject'").collect())
    assert wins == [("A", 0, 15), ("A", 18, 19), ("B", 6, 6)]


@pytest.mark.parametrize(("line", "want"), [([(0.5, None, 0.0, 0.0, None)] + [(5.0, None, 0.0, 0.0, None)] * 20, "dwell"), ([(0.5, None, 0.0, 0.0, None)] + [(0.05, None, 0.0, 0.0, None)] * 20, "active")])
def test_calm_is_relative(spark, line, want):
    assert frame(spark, {"r": line}).where("t = 0").first()["verdict"] == want


def test_seconds(spark):
    frozen = [(0.0, None, 0.0, 0.0, None)] * 10
    s = triage.seconds(frame(spark, {"r": frozen})).first()
    assert s["verdict_seconds_frozen"] == s["footage_seconds"] == 10.0 and s["verdict_seconds_subject"] == 0
    assert triage.seconds(frame(spark, {"r": frozen}, fps=None)).first()["footage_seconds"] == 100.0


def test_describe_replaces_its_columns_and_keeps_rows(spark):
    rows = [("a", t * 30 if t >= 0 else None, 5.0 if t >= 0 else None, 1.0, 0.0, 0.0, None, None, 30.0, 1 if t >= 0 else 0) for t in range(-1, 20)]
    report = spark.createDataFrame(rows, SCHEMA)
    from benthos.operators import reports

    once = reports.judge(report)
    twice = reports.judge(once)
    assert once.count() == twice.count() == 21 and once.columns == twice.columns
    assert once.where("footage_seconds is not null").count() == 1 and once.where("footage_seconds = 20.0").count() == 1
