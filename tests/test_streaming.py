from __future__ import annotations

import json

from pagelode.streaming.incremental import append_lines
from tests.test_sources import block, page


def test_only_new_pages_are_read(spark, tmp_path):
    source = tmp_path / "pages"
    source.mkdir()
    for n, texts in ((1, ["a", "b"]), (2, ["c"])):
        (source / f"p{n}.json").write_text(json.dumps(page(n, [block(*[[t] for t in texts])])))
        append_lines(spark, str(source), str(tmp_path / "lines"), str(tmp_path / "state")).awaitTermination()
    assert sorted(r["text"] for r in spark.read.parquet(str(tmp_path / "lines")).collect()) == ["a", "b", "c"]
