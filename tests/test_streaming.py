import pytest

from cohortlens.operators import mapping as M
from cohortlens.sources.io import scan_source
from cohortlens.streaming import start_ingest, stream_mapping

SPEC = M.NPS_SUPPORT


def _drop(folder, name, rows, header=None):
    header = header or SPEC.sources
    with open(folder / name, "w", encoding="utf-8") as f:
        f.write(";".join(header) + "\n")
        for i in rows:
            values = dict(zip(SPEC.sources, [f"c{i}", "05/01/2024", str(i % 11), "g", "1", "2", "3", "4", "5"]))
            f.write(";".join("" if i < 0 and c == SPEC.key else values.get(c, "extra") for c in header) + "\n")


def _run(spark, folder, **to):
    q = start_ingest(stream_mapping(spark, str(folder), SPEC, max_files_per_trigger=1), **to)
    try:
        q.awaitTermination(120)
        if q.exception():
            raise q.exception()
    finally:
        q.stop()


@pytest.mark.parametrize("to_sink", [False, True])
def test_two_starts_with_a_new_file_between_give_each_row_once(spark, tmp_path, to_sink):
    src, out, ckpt = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "ckpt")
    src.mkdir()
    to = dict(checkpoint=ckpt, sink=lambda df, _: df.write.mode("append").parquet(out)) if to_sink else dict(checkpoint=ckpt, path=out)
    header = ["EXTRA", *reversed(SPEC.sources)]
    _drop(src, "a.csv", [1, 2, -1], header)
    _run(spark, src, **to)
    _drop(src, "b.csv", [3, 4], header)
    _run(spark, src, **to)
    _run(spark, src, **to)
    seen = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    batch = sorted(tuple(r) for r in M.apply_mapping(scan_source(spark, str(src), SPEC), SPEC).collect())
    assert seen == batch and [r[0] for r in seen] == ["c1", "c2", "c3", "c4"]


def test_checkpoint_is_required_and_a_wanted_column_must_be_there(spark, tmp_path):
    _drop(tmp_path, "a.csv", [1], SPEC.sources[1:])
    with pytest.raises(ValueError, match="no column"):
        stream_mapping(spark, str(tmp_path), SPEC)
    with pytest.raises(TypeError):
        start_ingest(None, path=str(tmp_path))
