"""Rows-only queries against brute force on the small tables (sf0.001)."""

from collections import Counter

import numpy as np
import pytest
from pyspark.errors import AnalysisException

from conftest import SF0001
from vigil.operators import modeling
from vigil.operators.clustering import Centers
from vigil.sources.models import Layout, ModelBundle, load_bundle, save_bundle
from vigil.sources.records import record_lines


def _encode(line: str, bundle) -> np.ndarray:
    fields = line.split(",")
    out: list[float] = [float(fields[0])]
    for pos in (1, 2, 3):
        cats = bundle.dictionary.categories[pos]
        out += [1.0 if c == fields[pos] else 0.0 for c in cats]
    out += [float(x) for x in fields[4:-1]]
    x = np.array(out)
    mean, sd = np.array(bundle.stats.mean), np.array(bundle.stats.sd)
    return np.where(sd <= 0, x - mean, (x - mean) / np.where(sd <= 0, 1.0, sd))


def _published(spark, path):
    lines = record_lines(spark, SF0001)
    bundle, _ = modeling.build_model(lines, k=20, runs=1, seed=3, path=path)
    return lines, bundle


def test_apply_saved_model_matches_brute_force(spark, scratch):
    lines, built = _published(spark, f"{scratch}/m")
    tagged = modeling.apply_saved_model(lines, f"{scratch}/m")
    sizes = {r["cluster"]: r["cnt"] for r in modeling.cluster_sizes(tagged).collect()}
    bundle = load_bundle(spark, f"{scratch}/m")
    x = np.stack([_encode(r[0], bundle) for r in lines.collect()])
    c = bundle.centers.values
    nearest = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2).argmin(axis=1)
    assert dict(Counter(int(i) for i in nearest)) == sizes == built.cluster_sizes
    assert sum(sizes.values()) == len(x)


def test_detector_matches_brute_force(spark):
    from vigil.operators import anomaly

    lines = record_lines(spark, SF0001)
    det = anomaly.fit_anomaly_detector(lines, k=20, rank=100, runs=1, seed=3)
    raw = [r[0] for r in lines.collect()]
    x = np.stack([_encode(v, det) for v in raw])
    d = np.sqrt(((x[:, None, :] - det.centers.values[None, :, :]) ** 2).sum(axis=2).min(axis=1))
    threshold = np.sort(d)[::-1][99]
    assert det.threshold == threshold or abs(det.threshold - threshold) < 1e-9
    want = Counter(v for v, dist in zip(raw, d) if dist > threshold)
    got = Counter(r["value"] for r in anomaly.detect_anomalies(lines, det).collect())
    assert got == want and 0 < sum(got.values()) <= 99


def test_saves_do_not_mix_and_missing_parts_fail(spark, scratch):
    import shutil

    path = f"{scratch}/m"
    _published(spark, path)
    layout = Layout((0,), "|", "permissive")
    save_bundle(spark, ModelBundle(Centers(np.array([[1.0, 2.0]])), layout=layout), path)
    loaded = load_bundle(spark, path)
    assert loaded.centers.k == 1 and loaded.dictionary is None and loaded.stats is None and loaded.layout == layout
    tagged = modeling.apply_saved_model(spark.createDataFrame([("a|1|2|l",)], "value STRING"), path).collect()
    assert [(r["label"], r["cluster"], r["distance"]) for r in tagged] == [("l", 0, 0.0)]
    whole = f"{scratch}/n"
    _published(spark, whole)
    folder = spark.read.parquet(f"{whole}/manifest").first()["folder"]
    shutil.move(f"{whole}/{folder}/dictionary", f"{scratch}/away")
    with pytest.raises(AnalysisException):
        load_bundle(spark, whole)
