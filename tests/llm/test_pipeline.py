"""The stages against plain Python, one after another on what the one before kept."""

import collections
import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from citelake.llm.token_files import tokenizer_path
from citelake.llm.toxicity import score_toxicity
from tests.llm.tables import SF, given
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_near_dups import brute as groups


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, apply in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        apply(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    every = given("documents")

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    toxic = {r.doc_id for r in score_toxicity(spark.read.parquet(f"{SF}/documents.parquet"), labels).collect() if r.predicted}
    left = [d for d in every if d["doc_id"] not in toxic]
    assert sorted(r.doc_id for r in kept["drop_toxic"]) == [d["doc_id"] for d in left]

    found = groups([(d["doc_id"], d["text"]) for d in left], 5)
    left = [d for d in left if not found[d["doc_id"]][0] or found[d["doc_id"]][1] == d["doc_id"]]
    assert sorted(r.doc_id for r in kept["drop_near_duplicates"]) == [d["doc_id"] for d in left]

    leaked = {d for d, _ in leaks([(d["doc_id"], d["text"]) for d in left], [(b["item_id"], b["text"]) for b in given("benchmark")])}
    left = {d["doc_id"]: d for d in left if d["doc_id"] not in leaked}
    assert leaked and sorted(r.doc_id for r in kept["drop_contaminated"]) == sorted(left)

    times = collections.Counter(r.doc_id for r in kept["mix_sources"])
    assert set(times) <= set(left) and set(times.values()) <= {1, 2}
    assert all(r.text == left[r.doc_id]["text"] for r in kept["mix_sources"])

    tokenizer = Tokenizer.from_file(tokenizer_path())
    start = 0
    rows = sorted(kept["write_token_files"], key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted(times.elements())
    for r in rows:
        ids = tokenizer.encode(left[r.doc_id]["text"], add_special_tokens=False).ids + [0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)

    whole = corpus_pipeline.run(spark, SF).collect()
    assert sorted(whole) == sorted(rows)
