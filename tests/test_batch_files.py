"""What ``batch_predict`` leaves on disk."""

import os

from ringspan import session
from ringspan.plans import model_queries as Q
from ringspan.sources import readers as R
from ringspan.sources import writers as W


def test_batch_predict_keeps_compressed_predictions_only(spark, sf):
    since = len(session._scratch)
    found = Q.batch_predict(spark, sf)
    left = session._scratch[since:]
    assert [os.path.basename(p).rpartition("-")[0] for p in left] == ["predictions"]
    parts = [f for f in os.listdir(left[0].removeprefix("file:")) if f.startswith("part-")]
    assert parts and all(f.endswith(".json.gz") for f in parts)
    rows = Q._scored_calls(spark, sf)
    equal = found.groupBy("equal").count().collect()
    assert [(r["equal"], r["count"]) for r in equal] == [(True, rows.count())]


def test_compressed_lines_are_the_same_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "COMPRESSED_ROWS", 4)
    df = spark.createDataFrame([(1, "ä\n\"x\""), (2, None), (2, None), (None, "")] * 3, "id int, t string").coalesce(1)
    W.write_jsonl(df, str(tmp_path / "plain"))
    W.write_jsonl(df, str(tmp_path / "small"), compression="gzip")
    plain, small = (sorted(map(str, R.scan_jsonl(spark, str(tmp_path / n), df.schema).collect())) for n in ("plain", "small"))
    assert plain == small and len(small) == 12
    assert len([f for f in os.listdir(tmp_path / "small") if f.endswith(".gz")]) == 3
