"""Custom operators against brute force on random inputs (multi-block paths forced
with tiny block widths and partition counts)."""

import statistics

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lateflow.plans.rank import exact_median
from lateflow.plans.scan import first_at_or_after, prefix_scan

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

keys_values = st.dictionaries(st.integers(min_value=-50, max_value=400),
                              st.one_of(st.none(), st.integers(-1000, 1000)),
                              min_size=1, max_size=40)


@SETTINGS
@given(data=keys_values, width=st.sampled_from([1, 3, 16, 1000]))
def test_prefix_scan_matches_running_max(spark, data, width):
    df = spark.createDataFrame(sorted(data.items()), "k BIGINT, v BIGINT")
    got = {r["k"]: (r["prev_max"], r["upto_max"], r["idx"])
           for r in prefix_scan(df, "k", "v", width).collect()}
    best, want = None, {}
    for i, (k, v) in enumerate(sorted(data.items())):
        prev = best
        if v is not None:
            best = v if best is None else max(best, v)
        want[k] = (prev, best, i)
    assert got == want


@SETTINGS
@given(steps=st.lists(st.integers(0, 500), min_size=0, max_size=25, unique=True),
       queries=st.lists(st.integers(-20, 520), min_size=1, max_size=25),
       width=st.sampled_from([1, 7, 50, 10_000]))
def test_first_at_or_after_matches_scan(spark, steps, queries, width):
    steps = sorted(steps)  # monotone: batch id grows with the watermark
    sdf = spark.createDataFrame([(w, i, w) for i, w in enumerate(steps)],
                                "wm BIGINT, batch_id BIGINT, watermark_us BIGINT")
    qdf = spark.createDataFrame([(q,) for q in queries], "end_us BIGINT")
    got = sorted(tuple(r) for r in first_at_or_after(
        qdf, "end_us", sdf, "wm", ["batch_id", "watermark_us"], width).collect())
    want = []
    for q in queries:
        hit = next(((i, w) for i, w in enumerate(steps) if w >= q), (None, None))
        want.append((q, *hit))
    assert got == sorted(want, key=lambda t: tuple((x is None, x) for x in t))


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", "c"]),
                               st.one_of(st.none(), st.integers(0, 20).map(float))),
                     min_size=1, max_size=60),
       hot=st.integers(0, 40))
def test_exact_median_matches_statistics(spark, rows, hot):
    rows = rows + [("a", 7.0)] * hot  # a hot group with a hot value
    data = [(g, v, f"id{i}") for i, (g, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "g STRING, v DOUBLE, id STRING")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        got = {r["g"]: r["median"] for r in exact_median(df, ["g"], "v", "id").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    groups: dict[str, list[float]] = {}
    for g, v, _ in data:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert got == {g: statistics.median(vs) for g, vs in groups.items()}
