import json
import sys

from pyspark import cloudpickle

from pagewright import batch
from pagewright.config import Settings
from pagewright.operators.incremental import VersionedTable
from pagewright.sources.plugins import ExtractionError

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Fake:
    def extract(self, content, filename):
        if content == b"bad":
            raise ExtractionError("damaged")
        return {1: content.decode(), 2: "second", 3: "third"}


def test_batch_twice(spark, tmp_path):
    (tmp_path / "input/sub").mkdir(parents=True)
    for name, body in (("good.pdf", b"hello"), ("sub/same.PDF", b"hello"), ("bad.pdf", b"bad")):
        (tmp_path / "input" / name).write_bytes(body)
    settings = Settings(f"{tmp_path}/input", f"{tmp_path}/output", f"{tmp_path}/failed")
    counts, code = batch.run(spark, settings, Fake)
    assert code == 1 and counts == {"discovered": 3, "documents": 1, "pages": 3, "native_pages": 3, "ocr_pages": 0, "failed": 1, "skipped": 1}
    text = (tmp_path / "output/sub/same.txt").read_text()
    assert text.startswith("DOCUMENT: same.PDF\n\n=== PAGE 1 ===\n\nhello\n\n=== PAGE 2 ===") and text.endswith("third\n")
    assert json.loads((tmp_path / "output/good.json").read_text())["page_count"] == 3 and not (tmp_path / "output/bad.txt").exists()
    assert (tmp_path / "failed/bad.pdf").read_bytes() == b"bad" and (tmp_path / "output/good.cleaned.txt").exists()
    (tmp_path / "input/bad.pdf").write_bytes(b"mended")
    counts, code = batch.run(spark, settings, Fake)
    assert code == 0 and counts["documents"] == 1 and counts["skipped"] == 2
    rows = VersionedTable(spark, f"{tmp_path}/output/_tracker").snapshot().collect()
    assert sorted((r["filename"], r["status"]) for r in rows) == [("bad.pdf", "COMPLETE"), ("bad.pdf", "FAILED"), ("good.pdf", "COMPLETE"), ("same.PDF", "COMPLETE")]
    assert len({r["id"] for r in rows}) == 4
    assert not (tmp_path / "failed/bad.pdf").exists() and (tmp_path / "output/bad.txt").exists()
    counts, code = batch.run(spark, settings, Fake)
    assert (counts["documents"], counts["skipped"], code) == (0, 3, 0)
    # What was published goes when the file's next version can't be read.
    (tmp_path / "input/good.pdf").write_bytes(b"bad")
    counts, code = batch.run(spark, settings, Fake)
    assert code == 1 and counts["failed"] == 1 and (tmp_path / "failed/good.pdf").exists()
    assert not any((tmp_path / f"output/good.{x}").exists() for x in ("txt", "json", "cleaned.txt")) and (tmp_path / "output/sub/same.txt").exists()


def test_empty_tree(spark, tmp_path):
    (tmp_path / "input").mkdir()
    counts, code = batch.run(spark, Settings(f"{tmp_path}/input", f"{tmp_path}/output", ""), Fake)
    assert code == 0 and set(counts.values()) == {0}
