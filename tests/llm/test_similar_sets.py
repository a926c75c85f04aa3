"""Links between similar sets: what does not hang on the worker, the order of modules, or the size of a group."""

import os
import re
import subprocess
import sys

from pyspark.sql import functions as F

from tarnflow.llm import similar_sets
from tarnflow.llm.components import components


def test_constants_of_any_import_order():
    """Python workers import the modules in the order of their tasks; keys that two workers make must agree."""
    names = ["SHINGLE_BY", "ORDER_BY", "ORDER_ADD", "PERMUTE", "SHIFT", "BAND_BY", "WINDOW_BY", "RUN_BY"]
    show = f"print([[int(x) for x in getattr(substring_dedup, n, getattr(simhash, n, None)).ravel()] for n in {names}])"
    run = lambda order: subprocess.run([sys.executable, "-c", f"from tarnflow.llm import {order}\n{show}"], capture_output=True, text=True, check=True, env=os.environ).stdout
    assert run("simhash, substring_dedup") == run("substring_dedup, simhash") != ""


def test_components_by_one_task(spark):
    edges = [(1, 2), (2, 3), (3, 1), (5, 5), (9, 8), (8, 7), (None, 3), *[(i, i + 1) for i in range(20, 60)], *[(100, i) for i in range(101, 160)]]
    frame = spark.createDataFrame(edges, "u long, v long")
    few, many = ({tuple(r) for r in components(frame, at_once=n).collect()} for n in (0, 1000))
    assert few == many and len(many) > 90
    assert components(frame.limit(0), at_once=1000).count() == 0


def test_pairs_that_cannot_be_similar_are_not_made(spark):
    """Rows of one key: sketches of unequal sizes bring no pairs, crowded keys of one block are dealt once."""
    sets = {i: list(range(100)) if i < 3 else [*range(100), *range(1000 * i, 1000 * i + 300 + i)] for i in range(30)}
    keyed = spark.createDataFrame([(i, [7], (len(s),)) for i, s in sets.items()], "rep long, keys array<long>, sketch struct<size: int>")
    all_sets, asked = spark.createDataFrame(list(sets.items()), "rep long, shingles array<long>"), []

    def sets_of(reps):
        asked.append({r.rep for r in reps.collect()})
        return all_sets.join(reps, "rep", "left_semi")

    likely = lambda a, b: F.least(a["size"], b["size"]) >= 0.8 * F.greatest(a["size"], b["size"])
    found = [{tuple(r) for r in similar_sets.roots(keyed.where(w), sets_of, 0.8, 1, "t", full, likely, 1000, 64).collect()} for w, full in (("rep < 4", 32), ("true", 4))]
    assert found == [{(1, 0), (2, 0)}] * 2
    assert asked[0] | asked[1] == {0, 1, 2} and any(3 in x for x in asked[2:])


def joined_by_key(spark, since):
    """Rows of all inner joins by ``key`` alone that queries from number ``since`` on made, and the next query's number."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    store, rows, last = spark._jsparkSession.sharedState().statusStore(), 0, since
    runs = store.executionsList()
    for run in (runs.apply(i) for i in range(runs.size())):
        last = max(last, run.executionId() + 1)
        if run.executionId() < since:
            continue
        values, nodes = store.executionMetrics(run.executionId()), store.planGraph(run.executionId()).allNodes()
        for node in (nodes.apply(i) for i in range(nodes.size())):
            if re.search(r"Join \[key#\d+L?\], \[key#\d+L?\], Inner(, Build\w+)?(, false)?$", node.desc()):
                found = [node.metrics().apply(i) for i in range(node.metrics().size())]
                told = [values.get(m.accumulatorId()) for m in found if m.name() == "number of output rows"]
                rows += sum(int(x.get().replace(",", "")) for x in told if x.isDefined())
    return rows, last


def test_rows_of_crowded_keys_are_joined_once(spark):
    """Keys of one block, whose rows are of many components: no more rows by joins of the key than there are rows of it."""
    base = lambda i: range(1000 * i, 1000 * i + 90)
    sets = {i: [*base(i - i % 10 if i % 10 < 2 else i), *range(10_000_000 + 10 * i, 10_000_000 + 10 * i + 5)] for i in range(60)}
    shared = [7, 8, 9]
    keyed = spark.createDataFrame([(i, [100 + i, *shared]) for i in sets], "rep long, keys array<long>").repartition(3)
    all_sets = spark.createDataFrame(list(sets.items()), "rep long, shingles array<long>")
    _, since = joined_by_key(spark, 0)
    run = lambda block: {tuple(r) for r in similar_sets.roots(keyed, lambda reps: all_sets.join(reps, "rep", "left_semi"), 0.8, 4, "t", 4, block=block).collect()}
    expected = {(i + 1, i) for i in range(0, 60, 10)}
    assert run(64) == expected
    made, since = joined_by_key(spark, since)
    assert 0 < made <= len(sets) * len(shared)
    assert run(8) == expected  # each key in many blocks
    assert joined_by_key(spark, since)[0] <= 2 * len(sets) * len(shared)
