import json
import os
import sys

import pytest
from pyspark import cloudpickle

from pagewright import config
from pagewright.operators import metrics
from pagewright.sources import files, plugins, system
from pagewright.streaming import samples

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import tests


class FakeExtractor:
    def extract(self, content, filename):
        if content == b"bad":
            raise plugins.ExtractionError("damaged")
        if content == b"gap":
            return {1: "a", 3: "c"}
        return {i + 1: t for i, t in enumerate(content.decode().split("\f"))}


class FakeReader:
    def ocr(self, image):
        return [([(0, 0), (1, 0), (1, 1)], " line ", 0.5), (None, "  ", None)] if image else []


def test_extraction_gives_rows_for_pages_and_errors(spark, tmp_path):
    for name, body in (("a.pdf", b"one\ftwo"), ("copy.PDF", b"one\ftwo"), ("bad.pdf", b"bad"), ("gap.pdf", b"gap")):
        (tmp_path / name).write_bytes(body)
    rows = plugins.extract(files.scan_pdfs(spark, str(tmp_path)), FakeExtractor).collect()
    pages = sorted((r["page_no"], r["text"], r["page_count"]) for r in rows if not r["error"])
    assert pages == [(1, "one", 2), (2, "two", 2)]
    assert sorted(r["error"].split(":")[0] for r in rows if r["error"]) == ["ExtractionError", "ExtractionError"]


def test_recognition_keeps_empty_pages(spark):
    images = spark.createDataFrame([(1, 1, b"x"), (1, 2, b"")], "doc_id bigint, page_no int, image binary")
    got = sorted((r["page_no"], r["text"], r["confidence"]) for r in plugins.recognise(images, FakeReader).collect())
    assert got == [(1, "line", 0.5), (2, None, None)]


def test_settings():
    assert config.flag("X", True, {}) and not config.flag("X", True, {"X": " Off "})
    for bad in ("maybe", ""):
        with pytest.raises(ValueError):
            config.flag("X", True, {"X": bad})
    assert config.positive("N", 3, {}) == 3 and config.positive("N", 3, {"N": "7"}) == 7
    for name, f in (("N", config.positive), ("T", config.threshold)):
        with pytest.raises(ValueError):
            f(name, 1, {name: "-1"})
    s = config.Settings.from_env("/d", {"OCR_POOL_WORKERS": "2"})
    assert s.separate_pools and s.native_workers is None and not config.Settings.from_env("/d", {}).separate_pools


def test_limits():
    assert system.limit("max\n") is None and system.limit("1024") == 1024 and system.limit(str(1 << 62)) is None
    assert system.cpu_capacity("max 100000", 8) == 8.0 and system.cpu_capacity("150000 100000", 8) == 1.5 and system.cpu_capacity("", 4) == 4.0
    cpu, memory = system.process_sample(os.getpid())
    assert cpu > 0 and memory > 0 and system.process_sample(1 << 30) == (0.0, 0)


def test_sampler_writes_first_and_last(tmp_path):
    with system.Sampler(str(tmp_path), period=60):
        pass
    rows = [json.loads(p.read_text()) for p in sorted(tmp_path.glob("*.json"))]
    assert [r["seq"] for r in rows] in ([1], [1, 2]) and all(r["memory_bytes"] > 0 for r in rows)


def test_stream_equals_batch(spark, tmp_path):
    rows = [(run, i, i * 700_000 - (i % 5 == 0) * 700_000, (i * 37) % 900, 1000 + (i * 7919) % 500) for run in (1, 2) for i in range(1, 30)]
    folder = tmp_path / "in"
    folder.mkdir()

    def put(name, part):
        spark.createDataFrame(part, samples.SAMPLE).coalesce(1).write.json(str(tmp_path / name))
        for p in (tmp_path / name).glob("*.json"):
            p.rename(folder / f"{name}.json")

    out = str(tmp_path / "metrics.json")
    for name, part in (("first", [r for r in rows if r[1] < 15]), ("second", [r for r in rows if r[1] >= 15])):
        put(name, part)
        q, errors = samples.checkpoint_metrics(samples.running_summaries(samples.read_samples(spark, str(folder))), out, str(tmp_path / "cp"), every=None)
        q.awaitTermination()
        assert errors == []
    got = {r["run_id"]: r for r in json.load(open(out))}
    s = spark.createDataFrame(rows, samples.SAMPLE)
    for r in metrics.summarise(metrics.deltas(s), s, ["run_id"], 8.0).collect():
        for k in ("average_cores", "max_cores", "average_memory", "max_memory", "max_above_baseline"):
            assert got[r["run_id"]][k] == r[k], (k, got[r["run_id"]], r)
    assert got[1]["samples"] == 29
