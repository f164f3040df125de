import pytest
from pyspark.sql import functions as F

from folioflow.functions import context, nodes, text, vietnamese
from folioflow.operators import tables, tags


def run(spark, f, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string").select("i", f(F.col("text")).alias("x")).orderBy("i").collect()
    return [r.x for r in rows]


CASES = [
    (text.drop_page_markers, "<!-- PAGE : 1 -->\na<!--PAGE_END--> b<!-- kept -->", "ab<!-- kept -->"),
    (text.drop_invisible, "﻿a​b c\x07d\n\te�", "ab cd\n\te"),
    (text.drop_footer_lines, "a\nkcb_x 1 / 2 / 2020\n[Page 3]\nb", "a\nb"),
    (text.drop_image_links, "a ![x](b . jpeg) c", "a  c"),
    (text.drop_long_separators, "a\n" + "-" * 50 + "\nb", "a\nb"),
    (text.drop_gibberish_lines, "ok\n" + "200 A " * 21 + "\n" + "x " * 30 + "\n" + "a b c " * 4, "ok"),
    (text.drop_page_artifacts, "12\nTrang 4 x\n=====\nkept", "kept"),
    (text.drop_repeated_lines, f"{'a' * 50}\nb\n{'A' * 50} \n# {'c' * 50}\n# {'c' * 50}", f"b\n# {'c' * 50}\n# {'c' * 50}"),
    (text.fix_ocr_punctuation, "a .  b , c", "a. b, c"),
    (text.normalise_markdown, "# **T**\n* a\n3) b", "# T\n- a\n3. b"),
    (text.normalise_whitespace, "a  b  \n| c  d\r\n\n\n\ne", "a b\n| c  d\n\ne"),
    (text.clean, "\n\n<!--PAGE:1-->\na  \n\n\n\nb​ ", "a\n\nb"),
    (vietnamese.join_broken_lines, "thậ-\nn trọng\nvà đúng\nHết.\n\nMới", "thận trọng\nvà đúng\nHết.\nMới"),
    (vietnamese.fix_ocr_letters, "0ption Hell0 a.B c,d viet  nam", "Option Hello a. B c, d việt nam"),
    (vietnamese.normalise_headings, "a\n## - b", "a\n\n## b"),
    (vietnamese.normalise_bullets, "x. - + y\n-z", "x.\n  - y\n- z"),
    (vietnamese.replace_breaks, "a<br>b\n|c<BR/>d|", "a\nb\n|c d|"),
    (vietnamese.normalise_punctuation, "a–b....!!", "a-b.!"),
    (vietnamese.normalise_spacing, "a  b ,c 2.1", "a b, c 2. 1"),
    (nodes.replace_images, "![a](x) ![](y)", "[IMG: a] "),
    (nodes.space_headings, "a\n# b", "a\n\n# b"),
    (nodes.split_bulleted_headings, "- +a\n#### - b", "- a\n#### \n- b"),
    (nodes.drop_latex, r"$x$ \mathrm{kg}", " kg"),
    (nodes.comparable, "  A,  b!", "a b"),
    (tables.close_rows, "a||b", "|a| |b|"),
    (tables.join_numbers, "|3. 5|88, 4|", "|3.5|88,4|"),
    (tables.normalise_rows, "|£30 / |x|\n|1|2. 5", "|1|2.5|"),
    (context.source_name, "a_part_01.pdf", "a.pdf"),
    (context.document_id, "a b.pdf", "a_b"),
]


@pytest.mark.parametrize("f,value,want", CASES, ids=[f"{c[0].__name__}-{i}" for i, c in enumerate(CASES)])
def test_text_function(spark, f, value, want):
    assert run(spark, f, value, None) == [want, None]


def test_cleaning_is_idempotent(spark):
    raw = "<!--PAGE:1-->\n a \n\n\n\nb c"
    once = run(spark, text.clean, raw)[0]
    assert run(spark, text.clean, once) == [once]


def test_context_has_one_header_of_at_most_200_characters(spark):
    f = lambda t: context.with_context(F.lit("s.pdf"), t)
    once = run(spark, f, "# Title. " + "word " * 100, "", "[Ngữ cảnh: old]\nx")
    assert all(x.startswith("[Ngữ cảnh: Trích đoạn từ s.pdf") and x.count("[Ngữ cảnh:") == 1 and len(x.split("\n")[0]) <= 200 + len("[Ngữ cảnh: ]") for x in once)
    assert run(spark, f, *once) == once


def test_flags(spark):
    assert run(spark, nodes.is_administrative, "Căn cứ Nơi nhận Kính gửi", "Căn cứ", "") == [True, False, False]
    assert run(spark, nodes.is_name_list, "GS. A\nTS. B\nx", "GS. A", "a\nb\nc") == [True, False, False]
    assert run(spark, nodes.is_contents, "a ... 1\nb ... 2\nc ... 3", "a") == [True, False]


def test_domains_and_tags(spark):
    assert run(spark, tags.primary_domain, "bệnh viện và bác sĩ", "software", "", None) == ["Y học", "Công nghệ thông tin", "Khác", "Khác"]
    words = {"a": ["x", "c++"], "b": ["y"]}
    f = lambda t: tags.top_tags(t, F.lit("y"), F.lit(""), words)
    assert run(spark, f, "x x y", "c++ c++", "") == [["a", "b"], ["a", "b"], ["b"]]
