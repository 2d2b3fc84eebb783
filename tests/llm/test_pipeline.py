import hashlib
import random
import sys
from collections import Counter
from pathlib import Path

import public_tokenizers
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from brute import documents, saved  # noqa: E402, F401
from test_dedup import lines_by_hand  # noqa: E402
from test_texts import targets_by_hand  # noqa: E402

import corpus_pipeline  # noqa: E402


def test_stages_agree_with_brute_force(spark, documents, saved):
    rng = random.Random(12)
    line = brute.prose(rng, 14)
    good = [(i, f"{line}\n{brute.prose(rng, 150, 9)}" if i % 3 == 0 else brute.prose(rng, 150, 9), f"s{i % 4}") for i in range(40)]
    copies = [(100 + i, good[i][1], "s1") for i in range(5)]
    junk = [(200 + i, " ".join(w + "###" for w in brute.prose(rng, 90, 9).split()), "s0") for i in range(30)]
    odd = [(300, None, None), (301, "too short", "s0")]
    labels = spark.createDataFrame([(d, int(d < 200), 0) for d, _, _ in good + copies + junk], "doc_id long, quality int, toxic int")
    folder = saved(documents=documents(*good, *copies, *junk, *odd), labels=labels)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, states = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        out.write.parquet(f"{folder}/out/{len(states)}")
        docs = spark.read.parquet(f"{folder}/out/{len(states)}")
        states.append(docs.collect())
        assert docs.columns == columns or name == "BPE encoding"
    kept, lined, single, mixed, encoded = states
    assert {r["doc_id"] for r in kept} == {d for d, _, _ in good + copies}
    want = lines_by_hand([(r["doc_id"], r["text"]) for r in kept])
    assert {r["doc_id"]: r["text"] for r in lined} == {d: x[2] for d, x in want.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in lined)
    assert {r["doc_id"] for r in single} == {d for d, _, _ in good}
    sizes, taken, copies_of = Counter(), Counter(), Counter(r["doc_id"] for r in mixed)
    for r in single:
        sizes[r["source"]] += len(r["text"].split())
        taken[r["source"]] += len(r["text"].split()) * copies_of[r["doc_id"]]
    assert max(copies_of.values()) <= 3
    assert all(abs(taken[s] - t) <= 165 for s, t in targets_by_hand(sizes).items())
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] for r in mixed}
    assert Counter(r["doc_id"] for r in encoded) == copies_of
    assert all(list(r["ids"]) == tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids for r in encoded)
    whole = corpus_pipeline.run(spark, folder)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in whole.collect()) == sorted((r["doc_id"], r["n_tokens"]) for r in encoded)


def test_empty_documents(spark, documents, saved):
    folder = saved(documents=documents(), labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_last_stage_decodes(spark, documents):
    rows = [(1, "Ein Wort, ñandú\n\tétoile"), (2, ""), (3, None)]
    encoded = {r["doc_id"]: r for r in corpus_pipeline.token_ids(spark, documents(*rows), "").collect()}
    assert {d: r["decoded_sha256"] for d, r in encoded.items()} == {d: hashlib.sha256((t or "").encode()).hexdigest() for d, t in rows}
