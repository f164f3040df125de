from pyspark.sql import functions as F

from folioflow.operators import audit, chunks, cleaning, exports, fragments, pages, structure, tables, tags
from folioflow.plans import pipelines
from folioflow.sources import readers, writers


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc bigint, text string")


def test_section_paths_follow_levels(spark):
    rows = structure.section_paths(docs(spark, "a\n# A\nb\n## B\n1. x\nc\n# C\nd")).orderBy("pos").collect()
    assert [r.path for r in rows] == ["Document", "Document", "A", "A", "A > B", "A > B > 1", "A > B > 1", "C"]
    rows = structure.section_paths(docs(spark, "# A\n1. x\n## B\nII) y\nb\n#### D\n## E\n" + "# " + "t" * 60 + "\nend")).orderBy("pos").collect()
    assert [r.path for r in rows][4:] == ["A > 1 > B > II", "A > 1 > B > II", "A > 1 > B > II > D", "A > E", "t" * 40]


def test_chunks_keep_all_words_and_limits(spark):
    text = "# A\n" + "\n\n".join(f"Sentence number {i} goes here. And {i} more." for i in range(200)) + "\n\n| a | b |\n| c | d |\n\n# B\nshort"
    nodes = chunks.chunk(docs(spark, text, "", None, "x")).orderBy("doc", "idx").collect()
    own = [n for n in nodes if n.doc == 0]
    assert [n.idx for n in own] == list(range(len(own))) and {n.section for n in own} == {"A", "B"}
    assert " ".join(n.text for n in own).split() == [w for line in text.split("\n") if not line.startswith("#") for w in line.split()]
    assert all(n.tokens <= 400 + 150 for n in own) and [n.doc for n in nodes if n.doc != 0] == [3]


def test_rechunk_loses_nothing(spark):
    rows = [("s", i, f"{i:03d}", f"## H{i}\n" + "word " * 100) for i in range(1, 20)]
    nodes = spark.createDataFrame(rows, "source string, page int, id string, text string")
    for found in (chunks.rechunk(nodes, 2000, 500), chunks.rechunk_lines(nodes, 2000)):
        found = found.orderBy("n").collect()
        assert len(found) > 3 and " ".join(r.text for r in found).split() == " ".join(r[3] for r in rows).split()
        assert found[0].page_start == 1 and found[-1].page_end == 19 and all(a.page_end <= b.page_start + 1 for a, b in zip(found, found[1:]))


def test_pages(spark):
    paged = docs(spark, "<!--PAGE:1-->\nalpha beta\n<!-- page : 2 -->\ngamma delta")
    nodes = spark.createDataFrame([(0, 0, "alpha  beta"), (0, 1, "beta gamma"), (0, 2, "missing"), (0, 3, "delta")], "doc bigint, id int, text string")
    found = {r.id: (r.source_char_pos, r.page_start, r.page_end) for r in pages.assign_pages(nodes, paged).collect()}
    assert found == {0: (0, 1, 1), 1: (6, 1, 2), 2: (-1, None, None), 3: (17, 2, 2)}
    ranges = paged.select(pages.page_ranges(F.col("text")).alias("r")).select(*(pages.page_at(F.col("r"), F.lit(i)).alias(f"p{i}") for i in (0, 14, 30, 45, 99))).first()
    assert list(ranges) == [None, 1, None, 2, 2]


def test_greedy_duplicates_keep_the_longer(spark):
    rows = [(0, 0, "a b c d e f g h i j"), (0, 1, "a b c d e f g h i j!!"), (0, 2, "other"), (0, 3, "j i h g f e d c b a"), (1, 0, "a b c d e f g h i j"), (1, 1, ""), (1, 2, None)]
    nodes = spark.createDataFrame(rows, "doc bigint, idx bigint, text string")
    assert {(r.doc, r.idx) for r in audit.drop_duplicates(nodes).collect()} == {(0, 1), (0, 2), (1, 0), (1, 1)}


def test_pairs_equal_brute_force(spark):
    import random

    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + rng.choice("xy") for _ in range(12)) for _ in range(6)]
    texts = [" ".join(w if rng.random() > 0.05 else "new" for w in rng.choice(base).split()) for _ in range(60)]
    nodes = spark.createDataFrame([(0, i, t) for i, t in enumerate(texts)], "doc bigint, idx bigint, text string")
    sets, first = [frozenset(t.split()) for t in texts], {}
    for i, s in enumerate(sets):
        first.setdefault(s, i)
    want = {(min(i, j), max(i, j)) for a, i in first.items() for b, j in first.items() if i < j and len(a & b) / len(a | b) >= 0.8}
    assert {(r.a, r.b) for r in audit.duplicate_pairs(nodes).collect()} == want and want


def test_merge_short(spark):
    rows = [(0, 0, "s", "a" * 20, 1, 1), (0, 1, "s", "b" * 20, 2, 2), (0, 2, "u", "", None, None), (0, 3, "t", "c" * 4000, 3, 4)]
    found = audit.merge_short(spark.createDataFrame(rows, "doc bigint, idx bigint, section string, text string, page_start int, page_end int")).collect()
    assert [(r.idx, r.id, r.merged, r.page_start, r.page_end) for r in found] == [(0, "0_node_0000", [0, 1, 3], 1, 4)]


def test_tables(spark):
    text, found = tables.extract("Bảng 1\n| a | b |\n|---|---|\n| c | d |\n\nend\n# H\n|x|\ny")
    assert text == "Bảng 1\n[TABLE_REMOVED: Bảng 1]\n\nend\n# H\n|x|\ny" and found[0]["line_start"] == 1 and found[0]["line_end"] == 3
    fixed, actions, _ = tables.repair("|a|b|\n|-|\n|1|2|\n|more|\n|3|$x$4|")
    assert fixed == "|a|b|\n|---|---|\n|1|2 more|\n|3|4|" and len(actions) == 3
    assert tables.extract_tables(docs(spark, None, "")).orderBy("doc").collect()[0].text is None


def test_sinks_and_sources(spark, tmp_path):
    nodes = spark.createDataFrame([("d", 0, "d_node_0000", "s", "x", "d.pdf", 2, ["t"], "k")], "doc string, idx bigint, id string, section string, text string, source string, page int, tags array<string>, domain string")
    for kind in ("plain", "detailed", "training", "markdown", "json", "jsonl", "standard"):
        writers.export(nodes, kind, str(tmp_path / kind))
    assert spark.read.json(str(tmp_path / "standard")).select("source", "page").first() == ("d.pdf", 2)
    assert "**Node 1**" in exports.markdown(nodes).first().text
    writers.audit_report(nodes, str(tmp_path / "audit"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('[{"source": "s", "page": 1, "content": "x"}, {"source": "s", "page": 2, "content": "y"}]')
    (tmp_path / "in" / "broken.json").write_text("{")
    (tmp_path / "in" / "temp_b.json").write_text('{"source": "t"}')
    (tmp_path / "in" / "z.PDF").write_bytes(b"%PDF")
    assert readers.nodes(spark, str(tmp_path / "in")).count() == 2 and readers.pdf_files(spark, str(tmp_path / "in"), "Z.pdf").count() == 1


def test_empty_tables(spark):
    none = docs(spark, "x").where("false")
    assert pipelines.main(none).count() == 0 and structure.sections(none).count() == 0


def test_stream_gives_what_the_batch_gives(spark, tmp_path):
    from folioflow.streaming.cleaning import clean_stream

    docs(spark, "a  \n<!--PAGE:1-->b", "c").write.parquet(str(tmp_path / "in"))
    q = clean_stream(spark.readStream.schema("doc bigint, text string").parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("cleaned").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(60)
    assert sorted(tuple(r) for r in spark.table("cleaned").collect()) == sorted(tuple(r) for r in clean_stream(spark.read.parquet(str(tmp_path / "in"))).collect())


def test_rechunk_by_structure_equals_a_slow_form(spark):
    """All of a source at once, every place tried, against the streaming form."""
    import random
    import re

    def slow(parts, target, least, most):
        text = "\n\n".join(t for _, t in parts)
        text = re.sub(r"\n{3,}", "\n\n", text)
        bounds, at = [], 0
        for line in text.split("\n"):
            if re.match(r"#{1,6}\s+.+|\d+(?:\.\d+)*\.?\s+.+", line.strip()):
                bounds.append(at)
            at += len(line) + 1
        out, start = [], 0
        while start < len(text):
            goal, end = start + target, min(start + most, len(text))
            if goal >= len(text):
                stop = len(text)
            else:
                near = [b for b in bounds if start + least <= b <= end]
                blank = text.find("\n\n", max(goal - 200, start + least))
                lines = [p for p in range(goal, end) if text[p] == "\n"]
                stop = min(near, key=lambda b: abs(b - goal)) if near else blank + 2 if 0 <= blank < end else lines[0] + 1 if lines else end
            out.append(text[start:stop].strip())
            start = stop
        return [x for x in out if x]

    rng = random.Random(6)
    for _ in range(30):
        word = lambda: rng.choice(["alpha", "beta", "\n", "\n# Head\n", "\n2.1 item\n", "\n\n", "longer words here"])
        parts = [(i, " ".join(word() for _ in range(rng.randint(1, 60))).strip("\n") or "x") for i in range(rng.randint(1, 12))]
        found = [c["text"] for c in chunks.chunks_by_structure(iter(parts), 300, 80, 540)]
        assert found == slow(parts, 300, 80, 540)


def test_rechunk_lines_fields(spark):
    table = "\n".join(f"| r{i} | {'x' * 20} |" for i in range(20))
    nodes = spark.createDataFrame([("s.json", 1, "a", "# A\n" + "w " * 40), ("s.json", 2, "b", "## B\n1. one\n" + table), ("s.json", 0, "0", None)], "source string, page int, id string, text string")
    found = chunks.rechunk_lines(nodes, 150).orderBy("n").collect()
    assert [r.id for r in found] == [f"s_rechunk_{i:04d}" for i in range(len(found))] and {r.source for r in found} == {"s.json"}
    assert [(r.section_path, r.page_start, r.page_end, r.has_table, r.headings, r.numbered) for r in found][0] == ("Document", 1, 2, True, 2, 1)
    assert found[-1].section_path.startswith("A > B") and found[-1].page_end == 2 and all(r.chars == len(r.text) and r.tokens == len(r.text.split()) for r in found)
    assert chunks.rechunk_summary(chunks.rechunk_lines(nodes, 150)).first().chunks == len(found)


def test_clean_nodes(spark):
    rows = [(1, "![a](x) ![](y)\n# H\ntext<br>more"), (2, "Căn cứ a\nNơi nhận b\nKính gửi c"), (3, None), (4, "| a | b |\n|-|\n| 1 | $x$ |\n| 2 |"), (5, "[Page 1] ![z](<br>)"), (6, " | a |\n|b|\n|c|")]
    nodes = spark.createDataFrame(rows, "id bigint, text string").withColumn("actions_", F.lit(1))
    found = {r.id: r for r in cleaning.clean_nodes(nodes, True).collect()}
    assert found[1].text == "[IMG: a] \n\n# H\ntext\nmore" and found[1].actions == ["replaced_image_with_alt", "removed_image", "removed_local_images", "added_blank_before_header", "replaced_html_br_with_newline"]
    assert found[2].reason_skip == "administrative_content" and found[2].text == rows[1][1] and found[2].actions == [] and found[3].text is None
    assert found[4].text == "| a | b |\n|---|---|\n|1| 2|".replace("|1| 2|", "|1| 2|") and "cleaned_latex_in_table" in found[4].actions
    assert found[5].text == "" and found[6].warnings == ["TABLE WARNING: Cannot determine column count in header:  | a |"]
    total = cleaning.clean_summary(cleaning.clean_nodes(nodes, True)).first()
    assert (total.total_nodes, total.skipped_administrative_content, total.table_repairs, total.warnings) == (6, 1, 1, 1)
    assert cleaning.cleaning_report(cleaning.clean_nodes(nodes, True)).where("skip").first().flags.is_administrative


def test_tags_equal_a_slow_form(spark):
    import random
    import re

    dictionary = {"heart": ["tim", "tim mạch", "mạch máu"], "code": ["c++", "c", "node.js", "node"], "twice": ["ha ha", "tim"], "same": ["tim", "tim mạch", "TIM"], "none": []}
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["tim", "mạch", "máu", "c++", "c", "node.js", "node", "ha", "timx", "x-tim", "Tim", "\n", "c+"]) for _ in range(rng.randint(0, 25))) for _ in range(60)] + [None, ""]
    count = lambda t, k: len(re.findall(rf"(?<!\w){re.escape(' '.join(k.lower().split()))}(?!\w)", " ".join((t or "").lower().split())))
    want = []
    for t in texts:
        s = [(sum(count(t, k) for k in keys), label) for label, keys in dictionary.items()]
        want.append([(n, label) for n, label in sorted(s, key=lambda x: -x[0]) if n])
    rows = spark.createDataFrame(list(enumerate(texts)), "i bigint, text string").select("i", tags.scores(F.col("text"), dictionary).alias("s")).orderBy("i").collect()
    assert [[(x.score, x.label) for x in r.s] for r in rows] == want


def test_audit_stats_and_report(spark):
    rows = [(0, i, "s", t, None, None) for i, t in enumerate(["a b c d e", "a b c d e!", "e d c b a", "other words", "", "| x | y |\n| z | w |\n| q | r |"])]
    nodes = spark.createDataFrame(rows, "doc bigint, idx bigint, section string, text string, page_start int, page_end int")
    found = audit.audit_stats(nodes).first()
    assert (found.original_count, found.duplicate_pairs, found.after_dedup, found.table_not_removed_count) == (6, 3, 4, 1)
    assert "table left" in audit.report(nodes).first().text


def test_greedy_duplicates_equal_a_slow_form(spark):
    import random

    rng = random.Random(2)
    base = [[rng.choice("abcdefghijklmnopqrst") * 2 + str(rng.randint(0, 3)) for _ in range(14)] for _ in range(5)]
    texts = [" ".join(w if rng.random() > 0.06 else "new" for w in rng.choice(base)) + "!" * rng.randint(0, 5) for _ in range(70)] + ["", None, "!!"]
    words = [frozenset("".join(c for c in (t or "") if c != "!").split()) for t in texts]
    kept: list[int] = []
    for i, w in enumerate(words):
        near = next((j for j in sorted(kept) if (1.0 if not (w | words[j]) else len(w & words[j]) / len(w | words[j])) >= 0.85), None)
        if near is None:
            kept.append(i)
        elif len(texts[i] or "") > len(texts[near] or ""):
            kept.remove(near)
            kept.append(i)
    nodes = spark.createDataFrame([(7, i, t) for i, t in enumerate(texts)], "doc bigint, idx bigint, text string")
    assert sorted(r.idx for r in audit.drop_duplicates(nodes).collect()) == sorted(kept)


def test_pipelines_run_all_their_steps(spark):
    text = "# Heading\n\n" + "\n\n".join(f"Paragraph {i} tells of topic{i % 7 + 1} and word{i} at some length here." for i in range(1, 61)) + "\n\n![x](a.png)\n\n| a | b |\n|-|\n| 1 | 2 |\n"
    paged = text.replace("Paragraph 30", "<!--PAGE:2-->\nParagraph 30").replace("# Heading", "<!--PAGE:1-->\n# Heading")
    done = pipelines.main(docs(spark, text), docs(spark, paged), {"first": ["topic1", "topic2"]}).orderBy("idx").collect()
    assert done[0].page == 1 and done[-1].page_end == 2 and all("![x]" not in r.text for r in done) and done[0].tags == ["first"] and [r.idx for r in done] == list(range(len(done)))
    nodes = spark.createDataFrame([("a.pdf", i, f"{i:02d}", f"## Part {i}\n" + f"Sentence {i} of many words. " * 9) for i in range(1, 12)] + [("a.pdf", 12, "12", None)], "source string, page int, id string, text string")
    found = pipelines.clean_and_rechunk(nodes, 1000).collect()
    assert len(found) >= 2 and sum(r.text.count("Sentence 3 ") for r in found) == 9
    stats = pipelines.chunk_statistics(nodes, pipelines.clean_and_rechunk(nodes, 1000)).first()
    assert (stats.input_nodes, stats.sources, stats.output_chunks) == (12, 1, len(found))
    assert {r.source for r in pipelines.standard_chunks(pipelines.clean_and_rechunk(nodes, 1000)).collect()} == {"a.pdf"}
    parts = spark.createDataFrame([("d", k, f"<!--PAGE:1-->\nOpening of part {k} {'x' * 30}.\n<!--PAGE:2-->\nClosing of part {k}.") for k in (1, 2)], "doc string, part int, text string")
    both = pipelines.batch(parts, 2, spark.createDataFrame([("d", 4)], "doc string, pages int")).orderBy("idx").collect()
    assert [r.page for r in both] == [1, 3] and [r.page_end for r in both] == [2, 4] and both[1].id == "d_node_0001"


def test_fragments(spark):
    assert fragments.join_fragments("| a | b |\nmore\n\nand more\n# H\n" + "x" * 60) == "| a | b more and more |\n\n# H\n" + "x" * 60
    assert fragments.repair_blocks("t\n| a | b |\n|:--|:-:|--|\n| c | d\ncont |\nx") == "t\n| a | b |\n|---|---|\n| c | d cont |\nx"
    same, end = "a line of over twenty characters", "these words end the line above"
    assert fragments.drop_echoes(f"{same}\n{same}\nshort\nshort\nHere {end}\n{end} and go on") == f"{same}\nshort\nshort\nHere {end}  and go on"
    assert fragments.drop_echoes("| " + "y" * 50 + " |\n<b>" + "y" * 45 + "</b>") == "| " + "y" * 50 + " |"
    assert fragments.table_ranges("t\n| a | b |\n|-|-|\n| c | d |\nend") == [(2, 27)]
    nodes = spark.createDataFrame([(1, "| a | b |\n|-|-|\n| 1. 5 | $x$ |\n\n# End"), (2, " "), (3, None), (4, "Căn cứ a\nNơi nhận b\nKính gửi c")], "id bigint, text string")
    found = {r.id: r for r in fragments.process_nodes(nodes).collect()}
    assert found.keys() == {1, 4} and "| 1.5 | x |" in found[1].text and not found[1].skip_indexing and found[4].skip_indexing


def test_rechunk_keeps_tables_whole(spark):
    text = "word " * 60 + "\n" + "\n".join(f"| row {i} | {'x' * 10} |" for i in range(8)) + "\n" + "more words\n" * 30
    nodes = spark.createDataFrame([("s", 1, "a", text)], "source string, page int, id string, text string")
    whole = chunks.rechunk(nodes, 350, 100, 700, whole_tables=True).collect()
    assert all(sum(f"| row {i} " in r.text for i in range(8)) in (0, 8) for r in whole) and len(whole) > 1
    assert any(0 < sum(f"| row {i} " in r.text for i in range(8)) < 8 for r in chunks.rechunk(nodes, 350, 100, 700).collect())


def test_more_sources_and_reports(spark, tmp_path):
    for name in ("b.pdf", "B.PDF", "other b.pdf"):
        (tmp_path / name).write_bytes(b"%PDF")
    path = f"file://{tmp_path}"
    assert readers.find_pdf(spark, path, "b").first().path.endswith("/b.pdf") and readers.find_pdf(spark, path, "OTHER B").count() == 1 and readers.find_pdf(spark, path, "c").count() == 0
    assert readers.select_pdf(spark, path, "other").count() == 1
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "d.json").write_text('{"doc_id": "d", "nodes": [{"id": "d_0", "content": "x", "metadata": {"page_start": 3, "tags": ["t"]}}, {"id": "d_1", "content": "y", "section": "S", "page": 2}], "processing_info": {"source_file": "d.pdf"}}')
    (tmp_path / "docs" / "broken.json").write_text("{")
    rows = readers.documents(spark, f"{path}/docs").orderBy("idx").collect()
    assert [(r.id, r.page, r.source, r.section, r.tags) for r in rows] == [("d_0", 3, "d.pdf", "", ["t"]), ("d_1", 2, "d.pdf", "S", None)]
    nodes = spark.createDataFrame([(0, 0, "s", "![a](b) text", 1, 1), (0, 1, "s", "plain words here", 2, 2)], "doc bigint, idx bigint, section string, text string, page_start int, page_end int")
    writers.audit_report(nodes, f"{path}/audit")
    assert {r.type for r in spark.read.json(f"{path}/audit/rows").collect()} == {"summary", "flagged_node"}
    cleaned = cleaning.clean_nodes(spark.createDataFrame([("c", "s", 1, "![a](b)")], "chunk_id string, source string, page int, text string"))
    writers.cleaning_report(cleaned, f"{path}/clean")
    assert spark.read.json(f"{path}/clean/nodes").first().actions[0] == "replaced_image_with_alt"
    writers.rechunk_report(chunks.rechunk_lines(spark.createDataFrame([("s", 1, "a", "x y")], "source string, page int, id string, text string")), f"{path}/rechunk")
    assert spark.read.json(f"{path}/rechunk/summary").first().chunks == 1
