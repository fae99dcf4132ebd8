"""The type lattice."""

from __future__ import annotations

from loam.sources import types as ty


def test_lattice(spark, tmp_path):
    cols = {"b": ["true", "FALSE", None], "i": ["1", "-2147483648", "NA"], "l": ["1", "2147483648", ""], "d": ["1", "2.", "-.5E3"],
            "t": ["2024-02-29", "2024-01-01 10:20", "null"], "day": ["2024-02-29", "2020-01-01", None], "s": ["1", "one", "2"],
            "no": [None, "NA", ""], "odd": ["2023-02-29", "2024-01-01", None], "wide": ["9" * 19, "1", "2"], "blank": [" 1", "2", "3"],
            "a.b": ["é", "日本語", "x"]}
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"`{c}` string" for c in cols))
    got = {r["column"]: (r["type"], r["nulls"], r["known"], r["longest"]) for r in ty.column_types(df).collect()}
    assert got == {"b": ("boolean", 1, 2, 5), "i": ("int", 1, 2, 11), "l": ("bigint", 1, 2, 10), "d": ("double", 0, 3, 5),
                   "t": ("timestamp", 1, 2, 16), "day": ("date", 1, 2, 10), "s": ("string", 0, 3, 3), "no": ("string", 3, 0, None),
                   "odd": ("string", 1, 2, 10), "wide": ("double", 0, 3, 19), "blank": ("string", 0, 3, 2), "a.b": ("string", 0, 3, 3)}
    # parts merge: the same from any partitioning, and from one row at a time
    assert sorted(ty.column_types(df.repartition(3)).collect()) == sorted(ty.column_types(df).collect())
    empty = ty.column_types(df.limit(0)).collect()
    assert {(r["type"], r["nulls"], r["known"]) for r in empty} == {("string", 0, 0)}


def test_read_by_record(spark, tmp_path):
    df = spark.createDataFrame([("1", "a", "2024-01-01"), ("NA", "", "2024-01-02"), ("3", "c", "N/A")], "i string, s string, d string")
    path = str(tmp_path / "csv")
    df.write.option("header", True).csv(path)
    record = ty.infer_csv_types(spark, path, str(tmp_path / "record"))
    out = ty.read_csv_inferred(spark, path, record)
    assert out.dtypes == [("i", "int"), ("s", "string"), ("d", "date")]
    assert sorted((r.i, r.s) for r in out.where("i is not null").collect()) == [(1, "a"), (3, "c")]
    assert out.where("i is null").first().s is None
