"""Tests for the findings of round 4."""

from __future__ import annotations


def test_spelling_sends_no_table_to_the_driver(spark, monkeypatch):
    """no join of op12 holds a side on the driver, however small its files are."""
    from loam.llm import spelling
    plans, write = [], spelling.stored

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(spelling, "stored", noted)
    monkeypatch.setattr(spelling.near_pairs, "__defaults__", ("word", 1))
    counts = {"letters": 900, "leters": 90, "lettter": 9, "lexters": 8, "planets": 70, "planet": 7, "silence": 40}
    out = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert [p for p in plans if "Join" in p] and not [p for p in plans if "Broadcast" in p]
    got = {r.word: (r.form, r.root, r.n_near) for r in out.collect()}
    assert got["leters"] == ("letters", "letters", 2) and got["planet"] == ("planets", "planets", 1)
    assert got["silence"] == (None, "silence", 0)


def test_text_files_are_written_and_listed_by_few_tasks(spark, tmp_path):
    """one file a review and no checksum file beside it; a task lists several folders."""
    from loam.sources import files
    sc, root = spark.sparkContext, str(tmp_path / "reviews")
    rows = [(f"pos-{i}_{i % 10}.txt", f"review {i}\nof two lines") for i in range(90)]
    files.write_text_files(spark.createDataFrame(rows, "file string, review string"), root, "file")
    found = [p for p in (tmp_path / "reviews").rglob("*") if p.is_file() and p.name != "_SUCCESS"]
    assert len(found) == 90 and all(p.suffix == ".txt" for p in found)
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    sc.setJobGroup("listing", "listing")
    try:
        got = files.read_text_files(spark, root, label_pattern=r"_(\d+)\.txt(?:/|$)")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    track = sc.statusTracker()
    tasks = [track.getStageInfo(s).numTasks for j in track.getJobIdsForGroup("listing") for s in track.getJobInfo(j).stageIds]
    assert tasks and max(tasks) <= 8 * sc.defaultParallelism < 90 and spark.conf.get(key) == before
    assert sorted((r.review, r.sentiment) for r in got.collect()) == sorted((t + "\n", int(f[-5]) > 5) for f, t in rows)


def test_rows_of_few_features_keep_no_duals(spark, monkeypatch):
    """light rows of several blocks, two features: solved in two rounds, which store no
    duals and do not hold or deal the blocks again."""
    import numpy as np
    from loam.plans import dual
    rng = np.random.default_rng(3)
    x, n = rng.integers(1, 51, 3000) / 50, 3000
    y = 3 * x + 1 + rng.standard_normal(n)
    df = spark.createDataFrame([(float(b), [True], [[1]], [[float(a)]]) for a, b in zip(x, y)],
                               "y double, uses array<boolean>, idx array<array<long>>, val array<array<double>>")
    written, write = {}, dual.materialize

    def noted(d, name):
        written.setdefault(name, []).append((d._jdf.queryExecution().executedPlan().toString(), write(d, name)))
        return written[name][-1][1]

    monkeypatch.setattr(dual, "materialize", noted)
    fit = dual.ascend(df, [dual.Setting(0.0, 0.1)], "squared", tol=1e-11, passes=2, block_values=1000)
    m = np.c_[np.ones(n), x]
    w = {r.feature: r.weight for r in fit.weights.collect()}
    assert np.allclose([w[dual.INTERCEPT], w[1]], np.linalg.solve(m.T @ m / n + 0.1 * np.eye(2), m.T @ y / n), atol=1e-8)
    assert fit.reached == [True] and fit.rounds == 2 and written["dual-blocks"][0][1].count() > 3
    for plan, out in written["dual-round"]:
        assert "Exchange" not in plan and "InMemoryTableScan" not in plan and all(not r.duals for r in out.select("duals").collect())
