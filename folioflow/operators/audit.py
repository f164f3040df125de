"""Near-duplicate nodes, merging of short nodes, renumbering and audit figures."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby, islice

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nodes import noise, risky_tables, similarity, table_lines, word_set
from ..functions.text import let, tokens_by_length

#: Hash buckets of the word counts by which words are ordered.
BUCKETS = 1 << 18
#: Of the rarest words of two nodes so many are shared at least before the nodes are compared.
SHARED = 8
#: Pairs of nodes that are compared in one row, on the average.
COMPARED = 2048


def _frequencies(words: DataFrame) -> DataFrame:
    """One row: for every hash bucket of words (w: arrays of hashes) four times the binary logarithm of its count, in the bits from 56 on."""
    bucket = F.col("x").bitwiseAND(F.lit(BUCKETS - 1)).alias("b")
    counts = words.select(F.explode_outer("w").alias("x")).groupBy(bucket).agg(F.count("*").alias("n"))
    every = words.sparkSession.range(BUCKETS).join(counts, F.col("id") == F.col("b"), "left")
    level = F.shiftleft(F.least(F.lit(120), F.round(4 * F.log2(F.coalesce("n", F.lit(1)))).cast("bigint")), 56)
    return every.groupBy().agg(F.transform(F.array_sort(F.collect_list(F.struct("id", level.alias("level")))), lambda x: x.level).alias("frequency"))


def _sets(nodes: DataFrame) -> DataFrame:
    """(doc, idx, size, k): of every node the characters and what its word set agrees by; kept, since words are costly to make."""
    return nodes.select("doc", "idx", F.length("text").alias("size"), let(word_set(F.col("text")), _identity).alias("k")).persist()


def duplicate_classes(nodes: DataFrame, sets: DataFrame | None = None) -> DataFrame:
    """(doc, idx, class): every node's class of equal word sets; sets: those of the nodes, if there are any."""
    sets = _sets(nodes) if sets is None else sets
    first = sets.groupBy("doc", "k").agg(F.min("idx").alias("class")).select(F.col("doc").alias("to"), F.col("k").alias("of"), "class")
    return sets.join(first, F.col("doc").eqNullSafe(F.col("to")) & (F.col("k") == F.col("of"))).select("doc", "idx", "class")


def _identity(words: Column) -> Column:
    """128 bits by which equal word sets agree."""
    return F.struct(F.xxhash64(words).alias("a"), F.xxhash64(F.lit(1), words).alias("b"))


def _candidates(nodes: DataFrame, threshold: float, kept: bool = False) -> DataFrame:
    """(doc, a, b, ka, kb): pairs of classes of equal word sets, by their smallest idx and their identity, among which are all
    that reach the threshold: they share SHARED of their rarest words (all they must share, if these are fewer)."""
    hashes = nodes.select(F.transform(word_set(F.col("text")), lambda x: F.xxhash64(x)).alias("w"))
    least = lambda n: F.ceil(n * threshold - 1e-9)
    some = lambda n: F.least(F.lit(SHARED), least(n))
    rank = lambda f, x: F.get(f, x.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")).bitwiseOR(x.bitwiseAND(F.lit(2**56 - 1)))
    ranked = lambda w: let(F.col("frequency"), lambda f: F.sort_array(F.transform(w, lambda x: rank(f, F.xxhash64(x)))))
    rarest = lambda w: F.struct(F.size(w).alias("n"), F.slice(ranked(w), F.lit(1), (F.size(w) - least(F.size(w)) + some(F.size(w))).cast("int")).alias("t"), _identity(w).alias("k"))
    counted = nodes.select("doc", "idx", "text", _frequencies(hashes).scalar().alias("frequency"))
    own = counted.select("doc", "idx", let(word_set(F.col("text")), rarest).alias("s"))
    found = own.groupBy("doc", F.col("s.k").alias("k")).agg(F.min("idx").alias("idx"), F.first("s").alias("s"))
    found = found.persist() if kept else found  # Spark shares no shuffles above kept nodes
    rows = found.select("doc", "idx", F.col("s.n").alias("n"), F.posexplode("s.t").alias("at", "t"))  # empty sets make none
    a, b = rows.alias("a"), rows.alias("b")
    share = threshold / (1 + threshold)
    na, nb = F.col("a.n"), F.col("b.n")
    both = F.least(some(na), some(nb))
    like = (na >= threshold * nb - 1e-9) & (nb >= threshold * na - 1e-9) & (F.least(na - F.col("a.at"), nb - F.col("b.at")) + both - 1 >= share * (na + nb) - 1e-9)
    pairs = a.join(b, (F.col("a.doc") == F.col("b.doc")) & (F.col("a.t") == F.col("b.t")) & (F.col("a.idx") < F.col("b.idx")) & like)
    pairs = pairs.groupBy("a.doc", F.col("a.idx").alias("a"), F.col("b.idx").alias("b"), na.alias("na"), nb.alias("nb")).agg(F.count("*").alias("shared")).where(F.col("shared") >= F.least(some(F.col("na")), some(F.col("nb"))))
    side = lambda x: found.select("doc", F.col("idx").alias(x), F.col("s.n").alias(f"n{x}"), F.col("s.k").alias(f"k{x}"))
    return pairs.join(side("a"), ["doc", "a", "na"]).join(side("b"), ["doc", "b", "nb"]).select("doc", "a", "b", "ka", "kb")


def duplicate_pairs(nodes: DataFrame, threshold: float = 0.8, kept: bool = False) -> DataFrame:
    """(doc, a, b, similarity): pairs of nodes (doc, idx, text) of a document whose word sets reach the Jaccard threshold.

    Nodes with equal word sets, empty ones included, are one class, named by its smallest idx; pairs are of classes, so
    that n copies make n rows in duplicate_classes() and no n squared pairs. Prefix filter: two sets that reach the
    threshold share some of their rarest words, so a node makes rows for these alone; its words are put in order within its
    row, by counts in a table of fixed size. Length and positions of shared words and their number rule out most other
    pairs. The others are compared in cells, each with the pairs of a few nodes: words go to a cell once and not to every
    pair. A pair's cell is the first node that its own first one is like; cells of many pairs are cut by the hashes of both.
    kept: the nodes are persisted.
    """
    pairs = _candidates(nodes, threshold, kept).persist()  # read several times; what made it is costly
    first = pairs.groupBy("doc", F.col("b").alias("a")).agg(F.min("a").alias("first"))
    placed = pairs.join(first, ["doc", "a"], "left").withColumn("cell", F.coalesce("first", "a")).drop("first")
    many = placed.groupBy("doc", "cell").agg(F.ceil(F.sqrt(F.count("*") / COMPARED)).alias("cuts"))
    cut = lambda k: F.pmod(F.col(f"{k}.a"), F.col("cuts"))
    cells = placed.join(many, ["doc", "cell"]).select("doc", F.struct("cell", cut("ka").alias("i"), cut("kb").alias("j")).alias("cell"), "a", "b", "ka", "kb")
    wanted = cells.select("doc", "cell", F.explode(F.array("a", "b")).alias("idx")).distinct()
    own = nodes.select("doc", "idx", let(word_set(F.col("text")), lambda w: F.struct(_identity(w).alias("k"), F.array_join(w, " ").alias("w"))).alias("s"))
    sets = wanted.join(own, ["doc", "idx"]).groupBy("doc", "cell").agg(F.collect_set("s").alias("sets"))
    both = cells.groupBy("doc", "cell").agg(F.collect_list(F.struct("a", "b", "ka", "kb")).alias("pairs")).join(sets, ["doc", "cell"])
    compared = lambda m: F.transform("pairs", lambda p: F.struct(p.a.alias("a"), p.b.alias("b"), similarity(F.element_at(m, p.ka), F.element_at(m, p.kb)).alias("similarity")))
    words_of = F.map_from_entries(F.transform("sets", lambda s: F.struct(s.k, F.split(s.w, " "))))
    found = both.select("doc", F.explode(let(words_of, compared)).alias("p")).select("doc", "p.*")
    return found.where(F.col("similarity") >= threshold - 1e-12).select("doc", "a", "b", F.round("similarity", 3).alias("similarity"))


def _resolve(members: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
    """The nodes of one document that go: members (doc, idx, class, size) are the nodes that are similar to any other."""
    near: dict[int, list[int]] = {}
    for a, b in zip(edges["a"], edges["b"], strict=True):
        near.setdefault(a, []).append(b)
        near.setdefault(b, []).append(a)
    size = dict(zip(members["idx"], members["size"], strict=True))
    kept: dict[int, list[int]] = {}  # by class, ascending
    home, gone = {}, []
    for i, c in sorted(zip(members["idx"], members["class"], strict=True)):
        rivals = [kept[k][0] for k in (c, *near.get(c, ())) if kept.get(k)]
        if rivals:
            first = min(rivals)
            if size[i] <= size[first]:
                gone.append(i)
                continue
            gone.append(first)
            kept[home[first]].remove(first)
        kept.setdefault(c, []).append(i)
        home[i] = c
    return pd.DataFrame({"doc": members["doc"].iloc[:1].repeat(len(gone)).to_numpy() if len(members) else [], "idx": gone})


def drop_duplicates(nodes: DataFrame, threshold: float = 0.85, sets: DataFrame | None = None, pairs: DataFrame | None = None) -> DataFrame:
    """nodes (doc, idx, text) that stay: each is compared with those kept before it in its document; at the first that is
    similar, the strictly longer one stays. Null texts are empty ones; nodes without a doc stay.

    Only nodes that are similar to any other are looked at in order, as rows of a few numbers; texts do not move. sets and
    pairs: _sets() and duplicate_pairs() of the nodes, null texts as empty ones, if there are any.
    """
    own = nodes.select("doc", "idx", F.coalesce("text", F.lit("")).alias("text")).where("doc is not null")
    sets = (_sets(own) if sets is None else sets).where("doc is not null")
    counted = sets.groupBy("doc", "k").agg(F.min("idx").alias("class"), F.count("*").alias("n"))
    pairs = (duplicate_pairs(own, threshold).persist() if pairs is None else pairs).select("doc", "a", "b")
    tied = counted.where("n > 1").select("doc", "class").unionByName(pairs.select("doc", F.col("a").alias("class"))).unionByName(pairs.select("doc", F.col("b").alias("class"))).distinct()
    members = sets.join(counted.join(tied, ["doc", "class"], "left_semi"), ["doc", "k"]).select("doc", "idx", "class", "size")
    kind = nodes.schema["doc"].dataType.simpleString()
    anew = lambda d: d.select(*(F.col(c).alias(c) for c in d.columns))  # noqa: E731  both have doc from the same rows
    gone = anew(members).groupBy("doc").cogroup(anew(pairs).groupBy("doc")).applyInPandas(_resolve, f"doc {kind}, idx {nodes.schema['idx'].dataType.simpleString()}")
    return nodes.join(gone.select(F.col("doc").alias("_doc"), F.col("idx").alias("_idx")), (F.col("doc") == F.col("_doc")) & (F.col("idx") == F.col("_idx")), "left_anti")


def document_minimum(nodes: DataFrame, least: int = 150) -> DataFrame:
    """(doc, least): half of the mean tokens of a document's nodes, at most `least`, at least 10."""
    mean = F.avg(tokens_by_length(F.coalesce("text", F.lit("")), 1))
    return nodes.groupBy("doc").agg(F.greatest(F.lit(10), F.least(F.lit(least), F.floor(mean * 0.5))).cast("bigint").alias("least"))


def _size(row: dict) -> int:
    return max(1, row["chars"] // 4)


def _longer(a: dict, b: dict) -> dict:
    """What counting needs of two joined rows; there is an empty line between their texts."""
    return a | {"chars": a["chars"] + 2 + b["chars"], "written": a["written"] or b["written"]}


def _joined(a: dict, b: dict) -> dict:
    starts = [x for x in (a["page_start"], b["page_start"]) if pd.notna(x)]
    ends = [x for x in (a["page_end"], b["page_end"]) if pd.notna(x)]
    return _longer(a, b) | {"text": f"{a['text']}\n\n{b['text']}", "page_start": min(starts, default=None), "page_end": max(ends, default=None), "merged": a["merged"] + b["merged"]}


def _same_section(rows: Iterator[dict], joined: Callable[[dict, dict], dict] = _joined) -> Iterator[dict]:
    """Rows that are short take in the next ones of their section until they are not."""
    held = None
    for r in rows:
        if held is not None and held["section"] == r["section"] and _size(held) < r["least"]:
            held = joined(held, r)
            continue
        if held is not None:
            yield held
        held = r
    if held is not None:
        yield held


def _with_next(rows: Iterator[dict], joined: Callable[[dict, dict], dict] = _joined) -> Iterator[dict]:
    """A row that is short takes in the next one, whatever its section."""
    for r in rows:
        after = next(rows, None) if _size(r) < r["least"] else None
        yield r if after is None else joined(r, after)


def merge_short(nodes: DataFrame, least: int = 150, minimum: DataFrame | None = None) -> DataFrame:
    """(doc, idx, id, section, text, page_start, page_end, merged): nodes (doc, idx, section, text, page_start, page_end).

    Nodes below the minimum of their document (document_minimum() of the nodes unless given) take in the next of their
    section until they reach it; empty ones go; then a node that is still short takes in the next, whatever its section.
    Pages are the first and the last, merged lists the old idx, and idx and id are given anew. A document's nodes stream
    through one task in order, which holds no more of them than a batch.
    """
    minimum = document_minimum(nodes, least) if minimum is None else minimum
    minimum = minimum.select(F.col("doc").alias("_doc"), "least")
    rows = nodes.select("doc", "idx", "section", F.coalesce("text", F.lit("")).alias("text"), "page_start", "page_end").join(minimum, F.col("doc").eqNullSafe(F.col("_doc"))).drop("_doc")
    rows = rows.repartition("doc").sortWithinPartitions("doc", "idx")
    kind = nodes.schema["doc"].dataType.simpleString()
    fields = ["doc", "idx", "id", "section", "text", "page_start", "page_end", "merged"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every = (r | {"merged": [int(r["idx"])], "chars": len(r["text"]), "written": bool(r["text"].strip())} for f in frames for r in f.to_dict("records"))
        done = (
            r | {"idx": n, "id": f"{r['doc']}_node_{n:04d}"}
            for _, own in groupby(every, key=lambda r: r["doc"])
            for n, r in enumerate(_with_next(r for r in _same_section(own) if r["written"]))
        )
        while some := list(islice(done, 1000)):
            yield pd.DataFrame(some, columns=fields).astype({c: "Int32" for c in ("page_start", "page_end")})

    return rows.mapInPandas(run, f"doc {kind}, idx bigint, id string, section string, text string, page_start int, page_end int, merged array<bigint>")


def merged_counts(nodes: DataFrame, minimum: DataFrame) -> DataFrame:
    """(doc, final_count): how many rows merge_short() makes of a document's nodes. Lengths and sections alone stream through
    its task, no texts."""
    text = F.coalesce("text", F.lit(""))
    rows = nodes.select("doc", "idx", "section", F.length(text).alias("chars"), text.rlike(r"(?U)[^\s\x1c-\x1f]").alias("written"))
    rows = rows.join(minimum.select(F.col("doc").alias("_doc"), "least"), F.col("doc").eqNullSafe(F.col("_doc"))).drop("_doc")
    rows = rows.repartition("doc").sortWithinPartitions("doc", "idx")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ("doc", "section", "chars", "written", "least")
        every = (dict(zip(names, r, strict=True)) for f in frames for r in zip(*(f[c] for c in names), strict=True))
        for doc, own in groupby(every, key=lambda r: r["doc"]):
            n = sum(1 for _ in _with_next((r for r in _same_section(own, _longer) if r["written"]), _longer))
            if n:
                yield pd.DataFrame({"doc": [doc], "final_count": [n]})

    return rows.mapInPandas(run, f"doc {nodes.schema['doc'].dataType.simpleString()}, final_count bigint")


def flags(nodes: DataFrame) -> DataFrame:
    """nodes (doc, idx, text) with noise counts, table lines and high-risk placeholders."""
    return nodes.select("doc", "idx", noise(F.col("text")).alias("noise"), table_lines(F.col("text")).alias("table_lines"), risky_tables(F.col("text")).alias("risky")).select(
        "doc", "idx", "noise.*", "table_lines", (F.col("table_lines") >= 3).alias("table_not_removed"), F.size("risky").cast("bigint").alias("risky_tables"), "risky"
    )


def summary(nodes: DataFrame) -> DataFrame:
    """One row for each document of nodes (doc, idx, text): number, mean tokens, and how many are noisy or have table issues."""
    f = flags(nodes)
    noisy = (F.col("image_links") > 0) | (F.col("footer_patterns") > 0) | (F.col("gibberish_lines") > 0)
    count = lambda c: F.count_if(c).alias
    sizes = nodes.groupBy("doc").agg(F.count("*").alias("final_count"), F.sum(tokens_by_length(F.col("text"), 1)).alias("tokens"))
    issues = f.groupBy("doc").agg(count(noisy)("noise_detected_count"), count(F.col("table_not_removed"))("table_not_removed_count"), count(F.col("risky_tables") > 0)("high_risk_table_removed_count"))
    return sizes.join(issues, "doc").withColumn("avg_tokens", F.round(F.col("tokens") / F.col("final_count"), 2))


def flagged(nodes: DataFrame, most: int = 20) -> DataFrame:
    """The first `most` nodes of every document with any issue: the list of the audit report."""
    f = flags(nodes).where("image_links > 0 or footer_patterns > 0 or gibberish_lines > 0 or table_not_removed or risky_tables > 0")
    return f.withColumn("rank", F.row_number().over(Window.partitionBy("doc").orderBy("idx"))).where(F.col("rank") <= most)


def audit(nodes: DataFrame, threshold: float = 0.85, least: int = 150) -> DataFrame:
    """Duplicates dropped, then short nodes merged and renumbered; nodes as for merge_short(). What counts as short is
    taken from all nodes, duplicates included."""
    nodes = nodes.select("doc", "idx", "section", "text", "page_start", "page_end").persist()  # read several times; what made it is costly
    texts = nodes.withColumn("text", F.coalesce("text", F.lit("")))
    return merge_short(drop_duplicates(nodes, threshold, pairs=duplicate_pairs(texts, threshold, True).persist()), least, document_minimum(nodes, least))


def audit_stats(nodes: DataFrame, threshold: float = 0.85, least: int = 150) -> DataFrame:
    """One row for each document of nodes as for audit(): original_count, duplicate_pairs, after_dedup, final_count, avg_tokens
    and effective_min_tokens of the nodes as they came, and their noise and table issues.

    duplicate_pairs counts pairs of nodes, those of equal word sets included: a class of n nodes has n (n - 1) / 2 of them,
    and two similar classes of n and m have n m; they are counted by these sizes and never listed.
    """
    lacking = {"section": F.lit(""), "page_start": F.lit(None).cast("int"), "page_end": F.lit(None).cast("int")}
    own = nodes.withColumns({c: v for c, v in lacking.items() if c not in nodes.columns}).select("doc", "idx", "section", "text", "page_start", "page_end").persist()
    texts = own.withColumn("text", F.coalesce("text", F.lit("")))
    sets, alike = _sets(texts), duplicate_pairs(texts, threshold, True).persist()  # both are read several times
    size = duplicate_classes(texts, sets).groupBy("doc", "class").agg(F.count("*").alias("n"))
    inside = size.select("doc", (F.col("n") * (F.col("n") - 1) / 2).alias("n"))
    side = lambda k: size.select("doc", F.col("class").alias(k), F.col("n").alias(f"n_{k}"))
    across = alike.join(side("a"), ["doc", "a"]).join(side("b"), ["doc", "b"]).select("doc", (F.col("n_a") * F.col("n_b")).cast("double").alias("n"))
    pairs = inside.unionByName(across).groupBy("doc").agg(F.sum("n").cast("bigint").alias("duplicate_pairs"))
    dedup = drop_duplicates(own, threshold, sets, alike)
    kept = dedup.groupBy("doc").agg(F.count("*").alias("after_dedup"))
    final = merged_counts(dedup, document_minimum(own, least))
    first = summary(own).drop("tokens").withColumnRenamed("final_count", "original_count")
    found = first.join(document_minimum(own, least).withColumnRenamed("least", "effective_min_tokens"), "doc").join(pairs, "doc", "left").join(kept, "doc", "left").join(final, "doc", "left")
    return found.na.fill(0, ["duplicate_pairs", "after_dedup", "final_count"])


def report(nodes: DataFrame, threshold: float = 0.85, least: int = 150) -> DataFrame:
    """(doc, text): the audit of every document in Markdown, its figures and its first flagged nodes."""
    line = lambda name, c: F.concat(F.lit(f"| {name} | "), F.col(c).cast("string"), F.lit(" |"))
    names = {"Nodes before": "original_count", "Duplicate pairs": "duplicate_pairs", "After deduplication": "after_dedup", "Nodes after": "final_count", "Mean tokens": "avg_tokens", "Least tokens": "effective_min_tokens", "With noise": "noise_detected_count", "Tables left": "table_not_removed_count", "High-risk tables removed": "high_risk_table_removed_count"}
    issue = F.concat_ws(", ", F.when(F.col("image_links") > 0, "images"), F.when(F.col("footer_patterns") > 0, "footers"), F.when(F.col("gibberish_lines") > 0, "gibberish"), F.when(F.col("table_not_removed"), "table left"), F.when(F.col("risky_tables") > 0, "high-risk table"))
    rows = flagged(nodes).groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("rank", F.concat(F.lit("- node "), F.col("idx").cast("string"), F.lit(": "), issue).alias("line")))).alias("rows"))
    stats = audit_stats(nodes, threshold, least).join(rows, "doc", "left")
    body = F.concat_ws("\n", F.concat(F.lit("# Audit of "), F.col("doc").cast("string")), F.lit("\n| figure | value |\n|-|-|"), *(line(k, v) for k, v in names.items()), F.lit("\n## Flagged nodes\n"), F.coalesce(F.array_join(F.transform("rows", lambda r: r.line), "\n"), F.lit("none")))
    return stats.select("doc", body.alias("text"))


def report_rows(nodes: DataFrame) -> DataFrame:
    """One row of type summary for each document and one of type flagged_node for each of its first flagged nodes."""
    first = summary(nodes).select("doc", F.lit("summary").alias("type"), F.lit(None).cast("bigint").alias("idx"), "final_count", "avg_tokens", "noise_detected_count", "table_not_removed_count", "high_risk_table_removed_count")
    rows = flagged(nodes).select("doc", F.lit("flagged_node").alias("type"), F.col("idx").cast("bigint").alias("idx"), "image_links", "footer_patterns", "gibberish_lines", "table_lines", "table_not_removed", "risky")
    return first.unionByName(rows, allowMissingColumns=True)
