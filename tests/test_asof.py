import bisect
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vintagemill.operators.asof import asof_joins
from vintagemill.plans import backfill, cli
from vintagemill.plans.registry import QUERIES

DAYS = [dt.date(2020 + m // 12, m % 12 + 1, 1) for m in range(30)]


def brute(left, rights):
    """Row by row: the last record of the key up to the day, the greatest of one day."""
    out = []
    for key, day, x in left:
        row = [key, day, x]
        for records in rights:
            known = sorted((d, v) for k, d, v in records if k == key and k is not None and d is not None)
            at = 0 if day is None else bisect.bisect_right([d for d, _ in known], day)
            row += [known[at - 1][1], known[at - 1][0]] if at else [None, None]
        out.append(tuple(row))
    return sorted(out, key=repr)


@pytest.mark.parametrize("few", [False, True])
def test_equals_brute_force(spark, ansi, few):
    rng = random.Random(1)
    keys = ["hot"] * 20 + [f"c{i}" for i in range(15)] + [None]
    left = [(rng.choice(keys), rng.choice([*DAYS, None]), i % 7) for i in range(900)]
    rights = [[(rng.choice(keys), rng.choice([*DAYS[::3], None]), rng.randrange(100)) for _ in range(200)] for _ in range(2)]
    frames = {
        name: spark.createDataFrame(records, f"k string, snapshot_date date, {name}_v int")
        for name, records in zip("ab", rights, strict=True)
    }
    df = spark.createDataFrame(left, "k string, day date, x int")
    joined = asof_joins(df, frames, "k", "day", few_left_rows=few)
    assert joined.columns == ["k", "day", "x", "a_v", "a_as_of", "b_v", "b_as_of"]
    assert sorted(map(tuple, joined.collect()), key=repr) == brute(left, rights)
    assert asof_joins(df, {}, "k", "day") is df
    empty = {name: frame.limit(0) for name, frame in frames.items()}
    assert asof_joins(df, empty, "k", "day", few_left_rows=few).where("a_as_of is not null").count() == 0


def test_hot_key_brings_a_row_per_day(spark):
    """A hundred thousand rows of one customer and month are one row when they move."""
    hot = F.format_string("hot%d", F.col("id") % 1).alias("k")
    day = [F.date_add(F.lit(DAYS[i]), (F.col("id") % 1).cast("int")) for i in (5, 4)]
    left = spark.range(100_000).select(hot, day[0].alias("day"), "id")
    right = spark.range(100_000).select(hot, day[1].alias("snapshot_date"), F.col("id").alias("v"))
    joined = asof_joins(left, {"r": right}, "k", "day")
    assert joined.agg(F.count("v"), F.min("v"), F.max("r_as_of")).first()[:] == (100_000, 99_999, DAYS[4])
    text = joined._jdf.queryExecution().executedPlan().toString()
    window = text[text.index("Window") :]
    # Both sides are folded, partly before the shuffle, below the window.
    assert window.count("partial_max") == 1 and window.count("HashAggregate(keys=[k") >= 2


def test_one_shuffle_of_the_rows(spark, sf_small):
    """All sides move in one union by customer; no join has a side of records."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = QUERIES["feature_store_asof"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    top = text[: text.index("Union")]
    assert top.count("Exchange") == 1 and "Join" not in top


def test_policies_on_the_command_line(spark, tmp_path):
    assert cli.dataset_specs(["clickstream=latest_as_of"])["clickstream"].fallback == "latest_as_of"
    for wrong in ("clickstream", "clicks=skip", "loans=newest"):
        with pytest.raises(ValueError, match="is not a dataset"):
            cli.dataset_specs([wrong])
    source = tmp_path / "in"
    source.mkdir()
    (source / "feature_clickstream.csv").write_text("Customer_ID,fe_1,snapshot_date\na,1,2023-02-01\n")
    base = ["--source", str(source), "--start", "2023-01-01", "--end", "2023-03-01", "--layer", "bronze"]
    months = {}
    for policy in ("latest_overall", "latest_as_of"):
        root = str(tmp_path / policy)
        assert cli.main([*base, "--root", root, "--fallback", f"clickstream={policy}"], spark) == 0
        found = backfill.Store(spark, root).months("bronze", "clickstream")
        months[policy] = sorted(r.processing_date.month for r in found.collect())
    assert months == {"latest_overall": [1, 2, 3], "latest_as_of": [2, 3]}
