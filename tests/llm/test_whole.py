"""Operators do the whole job: cases that a first version left out."""

import random

import corpus_pipeline
from folioflow.llm import simhash, substrings

DOCS = "doc_id bigint, text string"


def brute_passages(texts):
    """Texts without every sentence in a run of two or more sentences and MIN_WORDS words, or one of LONG_WORDS, of an earlier place."""
    seen, out = {}, []
    for i, t in enumerate(texts):
        pieces = substrings.pieces(t.encode())
        own = [tuple(p.lower().split()) for p in pieces]
        gone = set()
        for a in range(len(own)):
            for b in range(a + 1, len(own) + 1):
                if sum(map(len, own[a:b])) >= (10 if b - a > 1 else 40):
                    if tuple(own[a:b]) in seen:
                        gone |= set(range(a, b))
                    seen.setdefault(tuple(own[a:b]), i)
        out.append(b"".join(p for k, p in enumerate(pieces) if k not in gone).decode())
    return out


def test_whole_passages_equal_all_runs(spark):
    rng = random.Random(11)
    sentence = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.choice([1, 2, 3, 7, 25, 45]))) + "." for _ in range(24)]
    texts = [" ".join(rng.choice(sentence) for _ in range(rng.randint(0, 14))) for _ in range(60)]
    menu = "Ab. Cd. Ef. Gh. Ij. Kl. Mn. Op. Qr. St. Uv."
    texts += [f"Only here {i}. {menu}" for i in range(3)]
    found = substrings.dedup_passages(spark.createDataFrame(list(enumerate(texts)), DOCS), whole=True)
    got = {r.doc_id: r.text for r in found.collect()}
    assert got == dict(enumerate(brute_passages(texts))) and got[61] == "Only here 1." and got[60] == texts[60]


def test_whole_passages_in_scripts_without_blanks(spark):
    passage = "这是一个没有空格的长句子并且会在多个文档中重复.\n第二个句子也是这样的而且同样没有空格.\n"
    found = substrings.dedup_passages(spark.createDataFrame([(i, passage + f"x{i}") for i in range(2)], DOCS), whole=True)
    assert {r.doc_id: r.text for r in found.collect()} == {0: passage + "x0", 1: "x1"}


def test_pipeline_keeps_a_row_of_each_component(spark):
    rng = random.Random(4)
    text = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(60))
    t = [text() for _ in range(8)]
    assert len({simhash.fingerprint(x.encode()) for x in t}) == 8
    rows = [(1, t[0]), (1, t[1]), (1, t[1]), (2, t[2]), (None, t[2]), (None, t[3]), (None, t[3]), (None, t[4]), (None, t[5]), (7, t[0]), (3, t[6]), (3, t[7])]
    docs = spark.createDataFrame(rows, DOCS)
    kept = corpus_pipeline.keep_one_of_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    want = [(1, t[0]), (1, t[1]), (2, t[2]), (None, t[3]), (None, t[4]), (None, t[5]), (3, t[6]), (3, t[7])]
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, want))
