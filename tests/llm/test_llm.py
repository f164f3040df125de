"""Operators for training corpora: against brute force, SQL, round trips and held-out accuracy, and on awkward tables."""

import hashlib
import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from conftest import SMALL, same_rows
from pyspark.sql import functions as F

from folioflow.llm import chat, components, decontam, langid, linededup, packing, quality, queries, simhash, substrings, toxicity, warc
from folioflow.llm.common import table

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Nulls in every column, empty and blank texts, repeated rows, odd characters, a long text.
AWKWARD = [(1, "The cat.\nThe cat.", "en", "a", 1), (1, "The cat.\nThe cat.", "en", "a", 1), (2, None, "en", None, None), (None, "x y z", None, "a", 3), (None, None, None, None, None), (3, "", "en", "a", 0), (4, " \n\t", "de", "b", 3), (5, "é ü ñ 😀 İ\r\n|x|", "fr", "b", 9), (6, "word " * 30000, "en", "b", 150000), (7, "The cat.\n\nA dog.", "en", "a", 9)]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOCS).select("*", F.lit(1).alias("h"), F.lit(2).alias("row"), F.lit(3).alias("component_id"), F.lit("x").alias("kept"))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    got = queries.queries()[name](spark, SMALL)
    same_rows(got, queries.oracle_sql()[name], SMALL)


def jaccard(a, b):
    return len(a & b) / len(a | b)


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 14))] for _ in range(25)]
    texts = []
    for _ in range(60):
        lines = [" ".join(w if rng.random() > 0.06 else rng.choice(vocabulary) for w in rng.choice(base)) for _ in range(rng.randint(0, 5))]
        texts.append("\n".join(x if rng.random() > 0.2 else f" {x.upper()}\t" for x in lines))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    seen, want = [], {}
    for i, text in enumerate(texts):
        kept = []
        for line in text.split("\n"):
            w = frozenset(line.lower().split())
            if w and any(5 * len(w & s) >= 4 * len(w | s) for s in seen):
                seen.append(w)
                continue
            if w:
                seen.append(w)
            kept.append(line)
        want[i] = "\n".join(kept)
    assert {r.doc_id: r.text for r in linededup.dedup_lines(docs).collect()} == want


def test_line_dedup_of_a_crowd(spark):
    texts = [" ".join(f"c{i}" for i in range(30)).replace(f"c{k % 30} ", f"new{k} ") for k in range(200)]
    found = linededup.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    assert {r.doc_id for r in found.where("n_removed = 0").collect()} == {0}


def test_sketch_is_not_copied_into_rows(spark):
    found = spark.createDataFrame([(1, "a b")], "h bigint, norm string").withColumn("doc_id", F.lit(1))
    plan = linededup.signed(found, spark.createDataFrame([([0] * 8,)], "sketch array<tinyint>"), linededup.Fraction(4, 5))._jdf.queryExecution().optimizedPlan().toString()
    assert "AS sketch" not in plan.split("Project")[1]


def test_substrings_equal_brute_force(spark):
    rng = random.Random(9)
    sentence = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.choice([2, 4, 20, 45]))) + "." for _ in range(20)]
    texts = [" ".join(rng.choice(sentence) for _ in range(rng.randint(0, 8))) for _ in range(50)]
    seen, want = {}, {}
    for i, t in enumerate(texts):
        pieces = substrings.pieces(t.encode())
        own, gone = [p.lower().split() for p in pieces], set()
        for a in range(len(own)):
            for n in (1, 2, 3):
                run = own[a : a + n]
                if len(run) == n and sum(map(len, run)) >= (10 if n == 3 else 40):
                    key = tuple(map(tuple, run))
                    if key in seen:
                        gone |= set(range(a, a + n))
                    seen.setdefault(key, i)
        want[i] = b"".join(p for k, p in enumerate(pieces) if k not in gone).decode()
    found = substrings.dedup_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    assert {r.doc_id: r.text for r in found.collect()} == want


def test_substrings_of_rows_that_share_or_lack_an_id(spark):
    rng = random.Random(4)
    passage = [" ".join(f"{k}{rng.choice('abcdefgh')}{i}" for i in range(12)) + ". " for k in range(6)]
    rows = [(None, passage[0] + passage[1]), (None, passage[0] + passage[1]), (None, passage[0] + passage[1] + passage[2] + passage[3] + "own words."), (5, passage[2] + passage[3] + passage[4]), (5, passage[2] + passage[3] + passage[4]), (5, passage[3] + passage[4] + passage[5]), (7, "x"), (None, None), (None, None)]
    found = substrings.dedup_passages(spark.createDataFrame(rows, "doc_id bigint, text string"), True).collect()
    assert len(found) == len(rows)
    left = "".join(r.text or "" for r in found)
    assert [left.count(p.strip()) for p in passage] == [1] * 6 and left.count("own words.") == 1
    assert [r.n_removed for r in found if r.doc_id == 7] == [0] and sum(r.text is None for r in found) == 2
    none = substrings.dedup_passages(spark.createDataFrame([(None, "a b c d e f. g h i j k l. " * 2)] * 40, "doc_id bigint, text string")).collect()
    assert sorted(len(r.text.strip()) for r in none)[:39] == [0] * 39


def brute_components(ids, fps, limit):
    parent = list(range(len(ids)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(ids)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= limit:
            parent[top(i)] = top(j)
    least = {}
    for i, d in enumerate(ids):
        least[top(i)] = min(least.get(top(i), d), d)
    return {d: least[top(i)] for i, d in enumerate(ids)}


def test_simhash_equals_brute_force(spark):
    docs = table(spark, SMALL, "documents")
    rows = docs.select("doc_id", "text").collect()
    fps = [simhash.fingerprint(r.text.encode()) for r in rows]
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op2_simhash_dedup(spark, SMALL).collect()}
    want = brute_components([r.doc_id for r in rows], fps, 4)
    assert found == {r.doc_id: (f"{f:016x}", want[r.doc_id]) for r, f in zip(rows, fps, strict=True)}


def test_simhash_links_of_random_fingerprints(spark):
    rng = random.Random(2)
    fps = [rng.getrandbits(64) for _ in range(40)]
    fps += [f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))) for f in fps for _ in range(6)]
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in set(signed)], "fp bigint"))
    found = {r.node: r.component for r in components.components(edges).collect()}
    want = brute_components(list(range(len(fps))), fps, 4)
    for i, j in combinations(range(len(fps)), 2):
        if fps[i] != fps[j]:
            assert (want[i] == want[j]) == (found.get(signed[i], signed[i]) == found.get(signed[j], signed[j]))


def test_fingerprint_of_few_words():
    import xxhash

    assert simhash.fingerprint(None) == simhash.fingerprint(b" \n") == 0
    assert simhash.fingerprint(b"A  b") == xxhash.xxh64_intdigest(b"a b", 42)


def test_decontamination_finds_exact_and_near_phrases(spark):
    phrase = " ".join(f"p{i}" for i in range(13))
    docs = spark.createDataFrame([(1, f"x {phrase.upper()} y"), (2, phrase.replace("p6", "p6 extra")), (3, "p0 p1"), (4, None)], "doc_id bigint, text string")
    items = spark.createDataFrame([("a", phrase), ("b", "p0 p1"), ("c", ""), ("d", None)], "item_id string, text string")
    for block in (1 << 20, 1):  # a block of all items and one of each
        found = {r.doc_id: r for r in decontam.decontaminate(docs, items, 1, block).collect()}
        assert (found[1].n_words, found[1].n_hit, sorted(found[1]["items"])) == (15, 13, ["a", "b"])
        assert found[2]["items"] == ["b"] and found[2].near_items == ["a"] and found[3].n_hit == 2 and found[4].n_words == 0


def brute_hits(text, items):
    """Words hit and items found, by looking for every window at every place."""
    w, hit, found = decontam.words((text or "").encode()), set(), set()
    for item, t in items:
        own = decontam.words((t or "").encode())
        for i in range(max(1, len(own) - 12) if own else 0):
            window = own[i : i + 13]
            for k in range(len(w) - len(window) + 1):
                if w[k : k + len(window)] == window:
                    hit |= set(range(k, k + len(window)))
                    found.add(item)
    return len(w), len(hit), tuple(sorted(found))


def test_decontamination_of_repeated_rows_equals_brute_force(spark):
    rng = random.Random(8)
    line = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    texts = [line(rng.choice([0, 3, 15, 40])) for _ in range(12)] + [None]
    rows = [(i % 4 if i % 3 else None, texts[i % len(texts)]) for i in range(60)] + [(7, "a b")] * 5
    items = [("x", line(4)), ("y", line(15)), ("x", line(5)), (None, line(3)), ("z", ""), ("n", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want = sorted((str(d), *brute_hits(t, [(i or "", t) for i, t in items])) for d, t in rows)
    for block in (1, 100, 1 << 20):
        found = decontam.decontaminate(docs, spark.createDataFrame(items, "item_id string, text string"), 0, block).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_hit, tuple(r["items"])) for r in found) == want


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    docs = {r.doc_id: r.text for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()} | {-1: None, -2: "İΣ ﬁ <|endoftext|> a'll 12 é ß", -3: ""}
    found = packing.pack_documents(spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")).collect()
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append(r)
    for d, text in docs.items():
        ids = np.asarray([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        own = sorted(by[d], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in own] == [(k, s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes())) for k, s in enumerate(range(0, len(ids), 4096))]
    bins = {}
    for r in found:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 4096
    assert len(bins) <= 1.05 * sum(r.length for r in found) / 4096 + 1


def test_token_ids_of_random_text_equal_the_library():
    from tokenizers import Tokenizer

    tokenizer, encode = Tokenizer.from_file(packing.tokenizer_path()), packing.Encoder(packing.tokenizer_path())
    rng = random.Random(11)
    ranges = [(0x20, 0x7F), (0xA0, 0x250), (0x300, 0x370), (0x370, 0x500), (0x5D0, 0x700), (0xE00, 0xE80), (0x2000, 0x2070), (0x3040, 0x30FF), (0x4E00, 0x4F00), (0x1F600, 0x1F640), (0x09, 0x0E)]
    for _ in range(300):
        own = rng.choices(ranges, k=rng.randint(1, 3))
        text = "".join(rng.choice([chr(rng.randrange(*rng.choice(own))), rng.choice(" \n'.09aZ")]) for _ in range(rng.randint(0, 60)))
        assert np.frombuffer(encode([text.encode()])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_sum_of_squares_rule():
    def slow(sizes, capacity):
        left = []
        for s in sorted(sizes, reverse=True):
            def cost(gaps):
                return sum(n * n for g, n in zip(*np.unique([g for g in gaps if g], return_counts=True), strict=True))
            options = [(cost(left[:i] + [g - s] + left[i + 1 :]), g) for i, g in enumerate(left) if g >= s] + [(cost([*left, capacity - s]), capacity + 1)]
            best = min(options)
            if best[1] > capacity:
                left.append(capacity - s)
            else:
                left[left.index(best[1])] -= s
        return len(left)

    rng = random.Random(1)
    for _ in range(20):
        sizes = [rng.randint(1, 20) for _ in range(60)]
        bins, offsets = packing.pack(np.asarray(sizes), 20)
        assert len(set(bins.tolist())) == slow(sizes, 20)


def test_warc_archives(spark, tmp_path):
    rows = [(1, "u", "<p>same</p>"), (5, "u v", "<p>same</p>"), (3, None, None), (2, "w", ""), (7, "é", "ü" * 100000), (7, "é", "other"), (None, "n", "<p>same</p>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    manifest = warc.write_archives(pages, f"file://{tmp_path}")
    found = warc.read_archives(spark, f"file://{tmp_path}", manifest, payloads=True).collect()
    assert len(found) == len(rows) and sorted((r.page_id, r.refers_to) for r in found if r.refers_to is not None) == [(1, 5), (2, 3)]
    assert sorted((r.page_id or 0, bytes(r.payload)) for r in found if r.payload is not None) == sorted((p or 0, (h or "").encode()) for p, _, h in rows if p not in (1, 2))
    data = next(tmp_path.glob("*.zst")).read_bytes()
    assert int.from_bytes(data[:4], "little") == warc.MAGIC


def test_chat_layouts_and_escapes(spark):
    import json

    nasty = "<|im_end|>\n<|im_start|>user\n\\-</s> [INST] \\\\<\\-s>"
    records = [{"messages": [{"role": "user", "content": nasty}, {"role": "assistant", "content": nasty}]}, {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": nasty}]}, {"instruction": "i", "input": "x", "output": "o", "more": 1}, {"prompt": "p", "completion": "c"}, {"unknown": 1}, [], None]
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)] + [(7, "{"), (8, None)]
    found = {r.id: r for r in chat.format_records(spark.createDataFrame(rows, "id bigint, record string")).collect()}
    assert [found[i].mapping for i in range(9)] == ["messages", "conversations", "instruction", "prompt_completion", None, None, None, None, None]
    assert chat.parse(found[0].formatted) == [("user", nasty), ("assistant", nasty)] and chat.parse(found[2].formatted) == [("user", "i\n\nx"), ("assistant", "o")]
    for i in range(4):
        assert all(c not in x for turn in found[i].formatted.split(chat.END)[:-1] for x in [turn[len(chat.BEGIN) :]] for c in chat.CONTROLS)
    spans = list(zip(found[1].loss_begin, found[1].loss_end, strict=True))
    assert [chat.unescape(found[1].formatted[a:b]) for a, b in spans] == [nasty]


def test_quality_rules(spark):
    boiler = "Subscribe to our daily letter now please\n"
    rows = [(i, boiler * 3 + f"only {i}", "h") for i in range(20)] + [(100 + i, " ".join(f"x{i}{k}" for k in range(40)) + "\n" + boiler.strip(), "h") for i in range(5)] + [(200, None, "h"), (201, "a b c d e " * 10, "g")]
    found = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
    assert not found[0].kept and found[0].n_line_words == 21 and found[100].kept and found[200].base_failed and found[201].n_repeat_words == 50
    assert found[0].text == "only 0" and found[200].text is None and "Subscribe" not in found[100].text and found[201].text == rows[-1][1]


def test_quality_rules_count_documents_of_a_host(spark):
    """Copies are documents each, repeated rows are one; hosts are counted apart, null is one of them."""
    copies = [(i, "same line of a copied page\nand another line of it", "h") for i in range(12)]
    again = [(50, "line of one document in many rows\nwith words enough to pass the lower bound of ten", "h")] * 15
    rows = copies + again + [(100 + i, f"line of a host without name\n{' '.join(f'w{i}{k}' for k in range(30))}", None) for i in range(12)] + [(200, "line of a host without name " * 1 + " ".join(f"v{k}" for k in range(20)), "g")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").select("*", F.lit(1).alias("line"), F.lit(2).alias("removed"))
    found = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert not found[0].kept and found[0].text == "" and found[50].kept and found[50].n_line_words == 0
    assert found[100].kept and found[100].n_line_words == 6 and found[100].text.startswith("w00") and found[200].n_line_words == 0


def held_out_rows(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(langid.held_out("doc_id"))


def test_language_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    found = langid.op10_language_id(spark, sf).where("held_out").join(table(spark, sf, "documents").where("lang is not null and length(text) > 60").select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.97 * len(found) > 100


def test_language_scores_by_definition(spark):
    """Cosines of TF-IDF vectors made one n-gram at a time, against the vectorised form."""
    rng = random.Random(2)
    word = {"aa": lambda: "".join(rng.choice("abcd") for _ in range(4)), "zz": lambda: "".join(rng.choice("wxyzé") for _ in range(5))}
    rows = [(i, " ".join(word[k]() for _ in range(rng.randint(3, 30))), k) for i in range(40) for k in [rng.choice(["aa", "zz"])]]
    model = langid.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    texts = [(0, "abcd dcba!"), (1, "Wxyz, é 12 zyx"), (2, "abcd wxyz"), (3, None), (4, "12 !")]

    def slow(text):
        b, found = langid.cleaned(text), {}
        for i, x in enumerate(b):
            keys = [x] if x != 0x20 else []
            two = [(b[k] * 0x9E3B + b[k + 1] * 0x85EB) % 2**32 for k in (i, i + 1) if k + 1 < len(b)]
            if two:
                keys.append((two[0] ^ (two[0] >> 13)) % langid.BUCKETS)
            if i + 2 < len(b):
                three = (two[0] * 0x2F0B + b[i + 2] * 0xC2B3) % 2**32
                keys.append((three ^ (three >> 11)) % langid.BUCKETS)
            for k in keys:
                found[k] = found.get(k, 0) + 1
        v = {k: n**0.5 * float(model.idf[k]) for k, n in found.items()}
        size = sum(x * x for x in v.values()) ** 0.5
        cosines = [sum(x * float(c[k]) for k, x in v.items()) / size for c in model.centroids]
        best = max(range(len(cosines)), key=cosines.__getitem__)
        return model.languages[model.owner[best]], cosines[best]

    found = {r.doc_id: r for r in langid.identify(spark.createDataFrame(texts, "doc_id bigint, text string"), model).collect()}
    for i, t in texts[:3]:
        lang, score = slow(t)
        assert found[i].lang_pred == lang and found[i].score == pytest.approx(score, abs=1e-4)
    assert [(found[i].lang_pred, found[i].score, found[i].rejected) for i in (3, 4)] == [("und", 0.0, True)] * 2


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    found = toxicity.op5_toxicity(spark, sf).where("held_out").join(table(spark, sf, "labels"), "doc_id").collect()
    toxic = [r for r in found if r.toxic == 1]
    assert sum(r.predicted for r in toxic) >= 0.8 * len(toxic) > 10
    assert sum(r.predicted for r in found if r.toxic == 0) <= 0.03 * len(found)


def test_toxicity_score_and_gradient_by_definition(spark):
    rng = np.random.default_rng(3)
    weights = np.zeros(toxicity.BUCKETS, np.float32)
    for word in ("vile", "scum", "kind"):
        weights[toxicity.features(word)] = rng.normal(0, 3, len(toxicity.features(word)))
    model = toxicity.Model(weights, -4.0)
    texts = ["A vile day. Kind scum!\nNothing here", "VILE vile. 12 34. ...", "", None, "!!! 5", "word. " * 300, "İ vile. x"]
    want = []
    for t in texts:
        none = 1.0
        for a, e in toxicity.sentences((t or "").lower()):
            own = {i for w in set(toxicity._WORD.findall((t or "").lower()[a:e])) for i in toxicity.features(w)}
            if own:
                none *= 1 - 1 / (1 + np.exp(4.0 - sum(float(weights[i]) for i in own)))
        want.append(1 - none)
    found = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), model).collect()}
    assert [found[i] for i in range(len(texts))] == pytest.approx(want)
    feature, sentence, owner = np.array([0, 1, 1, 2, 0]), np.array([0, 0, 1, 2, 3]), np.array([0, 0, 1, 2])
    plain, y, w, b = np.array([1.0, 0, 3]), np.array([1.0, 0, 1]), np.array([0.3, -0.7, 1.1]), -1.2
    value, gw, gb = toxicity.loss(w, b, feature, sentence, owner, plain, y)
    for k in range(3):
        step = np.eye(3)[k] * 1e-6
        assert gw[k] == pytest.approx((toxicity.loss(w + step, b, feature, sentence, owner, plain, y)[0] - value) / 1e-6, rel=1e-3)
    assert gb == pytest.approx((toxicity.loss(w, b + 1e-6, feature, sentence, owner, plain, y)[0] - value) / 1e-6, rel=1e-3)


def test_toxicity_learns_nothing_from_held_out_rows(spark):
    rows = [(i, f"vile thing {i}. fine words here." if i % 2 else f"fine words {i} here.") for i in range(200)]
    held = lambda d: zlib.crc32(str(d).encode()) % 4 == 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    models = [toxicity.fit(docs, spark.createDataFrame([(d, 1 - d % 2 if held(d) and turned else d % 2) for d, _ in rows] + [(9, None), (None, 1), (9, 1)], "doc_id bigint, toxic int")) for turned in (False, True)]
    assert models[0].bias == models[1].bias and (models[0].weights == models[1].weights).all() and models[0].weights.any()


def test_toxicity_learns_sentences_from_document_labels():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("aeioulmnrst") for _ in range(6))
    common = [word() for _ in range(80)]
    texts, labels = [], []
    for i in range(400):
        s = [" ".join(rng.choice(common) for _ in range(8)) + "." for _ in range(6)]
        if i % 2:
            s[rng.randrange(6)] = " ".join(rng.choice(common) for _ in range(6)) + f" {rng.choice(['vile', 'scum'])}."
        texts.append(" ".join(s))
        labels.append(i % 2)
    model = toxicity.train([toxicity.bag(t) for t in texts], np.asarray(labels))
    scores = [toxicity.noisy_or(model.sentence_scores(np.asarray([model.weights[f].sum() for f in toxicity.bag(t)]))) for t in texts]
    assert np.mean([(s > 0.3) == y for s, y in zip(scores, labels, strict=True)]) > 0.97


def test_awkward_tables(spark, awkward):
    """Nulls, empty and long texts, repeated rows and clashing columns: one row for each row, and the stated values."""
    n = len(AWKWARD)
    lines = linededup.dedup_lines(awkward).collect()
    assert len(lines) == n and {(r.doc_id, r.text) for r in lines if r.doc_id in (1, 2, 3, 7)} == {(1, "The cat."), (2, None), (3, ""), (7, "\nA dog.")}
    passages = substrings.dedup_passages(awkward).collect()
    assert len(passages) == n and all(r.text is None for r in passages if r.doc_id == 2) and passages[0].row.component_id == 3
    near = simhash.near_duplicates(awkward).collect()
    assert len(near) == n and {r.component_id for r in near if r.fp == 0} == {2}
    found = decontam.decontaminate(awkward, spark.createDataFrame([("i", "the cat")], "item_id string, text string")).collect()
    assert len(found) == n and {r.doc_id for r in found if r.n_hit} == {1, 7}
    assert packing.pack_documents(awkward).where("piece = 0").count() == n
    assert quality.judge(awkward).count() == n
    known = langid.identify(awkward, langid.fit(awkward)).collect()
    assert len(known) == n and all(r.lang_pred == "und" and r.rejected for r in known if r.doc_id in (2, 3, 4))
    assert toxicity.score(awkward, None).count() == n


def test_empty_tables(spark, awkward):
    none = awkward.where("false")
    items = spark.createDataFrame([], "item_id string, text string")
    for f in (linededup.dedup_lines, substrings.dedup_passages, simhash.near_duplicates, packing.pack_documents, quality.judge):
        assert f(none).count() == 0
    assert decontam.decontaminate(none, items).count() == 0 and decontam.decontaminate(awkward, items).where("n_hit > 0").count() == 0
    assert langid.fit(none) is None and langid.identify(none, None).count() == 0
    assert toxicity.fit(none, spark.createDataFrame([], "doc_id bigint, toxic int")) is None


def test_pipeline_stages(spark):
    """Every stage does what its operator says to its own input, and keeps the documents' columns."""
    import corpus_pipeline as p

    sf = SMALL
    docs = table(spark, sf, "documents")
    columns, kept = docs.columns, {r.doc_id: r for r in docs.collect()}
    for name, stage in p.STAGES:
        before, docs = kept, p.materialize(stage(spark, docs, sf), name)
        if name == "packing":
            assert {r.doc_id for r in docs.collect()} == set(before)
            continue
        assert docs.columns == columns
        kept = {r.doc_id: r for r in docs.collect()}
        assert docs.count() == len(kept) and set(kept) <= set(before)
        if name == "line_dedup":
            assert set(kept) == set(before)
            assert all(r.n_chars == len(r.text) for r in kept.values())
        if name == "simhash_dedup":
            want = brute_components(list(before), [simhash.fingerprint(r.text.encode()) for r in before.values()], 4)
            assert set(kept) == set(want.values())
        if name == "decontamination":
            windows = {tuple(w) for r in table(spark, sf, "benchmark").collect() for ws in [decontam.words(r.text.encode())] for w in (ws[i : i + 13] for i in range(max(1, len(ws) - 12)))}
            for d, r in before.items():
                ws = decontam.words(r.text.encode())
                hit = {k for size in {len(w) for w in windows} for i in range(len(ws) - size + 1) if tuple(ws[i : i + size]) in windows for k in range(i, i + size)}
                assert (d in kept) == (not (hit and 20 * len(hit) >= len(ws)))


def test_pipeline_stages_on_awkward_tables(spark, awkward):
    """Every stage on nulls, shared and null ids, clashing columns and an empty table: columns stay, no clean row goes."""
    import corpus_pipeline as p

    clash = awkward.select("*", F.lit(1).alias("rejected"), F.lit(2.0).alias("score"), F.lit("x").alias("lang_pred"), F.lit(3).alias("own"), F.lit(4).alias("wanted_own"), F.lit(5).alias("n_hit"))
    for name, stage in p.STAGES[:-1]:
        found = stage(spark, clash, SMALL)
        assert found.columns == clash.columns, name
        rows = found.collect()
        if name in ("line_dedup", "decontamination"):
            assert len(rows) == len(AWKWARD), name
        if name == "simhash_dedup":  # equal texts are one group each, texts without words another
            assert sorted(str(r.doc_id) for r in rows) == ["1", "2", "5", "6", "None"] or len(rows) >= 4
        assert all(r.n_hit == 5 and r.own == 3 for r in rows)
        assert stage(spark, clash.where("false"), SMALL).count() == 0, name


def test_digests():
    assert warc.digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ" and hashlib.sha1(b"").hexdigest()
