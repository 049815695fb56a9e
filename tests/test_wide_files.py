"""Wide files: what they take on disk, and lines that are aggregated without a sort."""

from pathlib import Path

from checks import q_sources
from checks.registry import QUERIES
from geoloom.sources import text_tables as TT


def test_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    """Compressed files of a bounded number of rows; null keys, repeated keys and files of one row are read whole."""
    rows = [(k, k * 1.5) for k in range(501)] + [(7, None), (None, 3.25), (9, 9.0), (9, 9.0)]
    spark.createDataFrame(rows, "o_orderkey bigint, o_totalprice double").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(q_sources, "scratch_path", lambda _, name: f"{tmp_path}/out/{name}-1")
    monkeypatch.setattr(q_sources, "WIDE_FILE_ROWS", 84)  # 505 rows: the last file has a single one
    found = QUERIES["s01_wide_files"](spark, str(tmp_path)).collect()
    text = lambda v: None if v is None else str(v)
    want = [(name, header, text(k), text(None if k is None else k % 7)) for name, header in (("plain", False), ("named", True)) for k, _ in rows]
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    for name in ("plain", "named"):
        files = list(Path(tmp_path, "out").rglob(f"{name}/part-*"))
        assert len(files) == 7
        raw = sum(70 * len(f"t00-{k};") for k, _ in rows)
        assert sum(f.stat().st_size for f in files) < raw / 3


def test_sniffing_sorts_no_lines(spark, tmp_path):
    """Finding the first line of each file must not sort the text of all of them."""
    for i in range(3):
        Path(tmp_path, f"f{i}.csv").write_text(f'\n \n"a{i}";b\n1;"x ""y"""\n"2\n3";4\n')
    dialects = TT.sniff(spark, [str(tmp_path)])
    plan = dialects._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Sort [" not in plan
    got = sorted((r.first, r.delimiter, r.multiline, r.quoted, r.lines) for r in dialects.collect())
    assert got == [(f'"a{i}";b', ";", True, True, 4) for i in range(3)]
