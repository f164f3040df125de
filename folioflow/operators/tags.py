"""Topic tags and domains from keyword dictionaries. Nodes are tagged in place, without a join, by one pass over the text."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import U, let, sub

#: Keywords of the domains, in order of preference.
DOMAINS = {
    "Y học": ["y học", "y tế", "bệnh viện", "bác sĩ", "điều trị", "chẩn đoán", "thuốc", "bệnh nhân", "lâm sàng", "phẫu thuật", "y khoa", "sức khỏe", "medical", "medicine", "healthcare", "hospital", "doctor", "patient"],
    "Công nghệ thông tin": ["công nghệ thông tin", "CNTT", "phần mềm", "lập trình", "máy tính", "dữ liệu", "database", "software", "programming", "IT", "computer", "internet", "web", "app", "cloud", "AI", "machine learning"],
    "Kinh tế - Tài chính": ["kinh tế", "tài chính", "ngân hàng", "đầu tư", "chứng khoán", "thị trường", "doanh nghiệp", "kinh doanh", "thương mại", "xuất nhập khẩu", "economics", "finance", "banking", "investment", "stock", "business"],
    "Luật": ["luật", "pháp luật", "quy định", "nghị định", "thông tư", "hiến pháp", "tòa án", "luật sư", "hợp đồng", "vi phạm", "hình sự", "dân sự", "law", "legal", "regulation", "court", "attorney", "contract"],
    "Giáo dục": ["giáo dục", "đào tạo", "trường học", "đại học", "sinh viên", "học sinh", "giảng viên", "giáo viên", "chương trình", "học tập", "thi cử", "education", "training", "university", "student", "teacher", "learning"],
    "Khoa học kỹ thuật": ["kỹ thuật", "công nghệ", "kỹ sư", "engineering", "technical", "cơ khí", "điện", "điện tử", "tự động hóa", "robot"],
    "Nông nghiệp": ["nông nghiệp", "trồng trọt", "chăn nuôi", "nông sản", "cây trồng", "vật nuôi", "agriculture", "farming", "crop", "livestock"],
    "Xây dựng": ["xây dựng", "kiến trúc", "công trình", "nhà ở", "bất động sản", "construction", "architecture", "building", "real estate"],
    "Du lịch - Khách sạn": ["du lịch", "khách sạn", "nhà hàng", "resort", "tourism", "hotel", "travel", "hospitality", "tour"],
    "Môi trường": ["môi trường", "sinh thái", "ô nhiễm", "khí hậu", "biến đổi khí hậu", "environment", "ecology", "pollution", "climate"],
}
OTHER = "Khác"


def load_dictionary(path: str) -> dict[str, list[str]]:
    """A dictionary of labels and keywords from a JSON object; large ones are given by a file, not by code."""
    with open(path, encoding="utf-8") as f:
        return {str(k): [str(x) for x in v] for k, v in json.load(f).items()}


def normalised(text: Column) -> Column:
    return F.trim(sub(F.lower(F.coalesce(text, F.lit(""))), rf"{U}\s+", " "))


def keyword_count(text: Column, keyword: str) -> Column:
    """How often a keyword stands in normalised text, not inside a longer word."""
    return F.regexp_count(text, F.lit(rf"{U}(?<!\w)\Q{_own(keyword)}\E(?!\w)"))


def _own(keyword: str) -> str:
    return re.sub(r"\s+", " ", keyword.lower().strip())


def _prefix_tree(keywords: list[str]) -> str:
    """A pattern for the longest of the keywords, by their common beginnings: a regular expression engine then tries a
    handful of branches at a place instead of every keyword."""
    if not keywords:
        return ""
    ends = "" in keywords
    branches: dict[str, list[str]] = {}
    for k in keywords:
        if k:
            branches.setdefault(k[0], []).append(k[1:])
    parts = [f"\\Q{c}\\E" + _prefix_tree(rest) if c != "\\" else r"\\" + _prefix_tree(rest) for c, rest in sorted(branches.items())]
    if not parts:
        return ""
    return f"(?:{'|'.join(parts)})" + ("?" if ends else "")


def _meets_itself(keyword: str) -> bool:
    """Whether two occurrences of a keyword can overlap: a beginning of it, up to a word's end, is also an end of it."""
    return any(keyword.endswith(keyword[:n]) and (not keyword[n].isalnum() or not keyword[n - 1].isalnum()) for n in range(1, len(keyword)))


def found_keywords(text: Column, keywords: list[str]) -> Column:
    """array<string>: at every place of normalised text where a keyword stands the longest one, in one pass.

    The pattern matches no characters, so keywords may overlap. Of keywords that begin a longer one, longer ones stand for
    both; standing() tells which.
    """
    return F.regexp_extract_all(text, F.lit(rf"{U}(?<!\w)(?=({_prefix_tree(sorted({_own(k) for k in keywords} - {''}))})(?!\w))"), F.lit(1))


def standing(keyword: str, keywords: set[str]) -> list[str]:
    """The keywords whose occurrence is one of this keyword too."""
    return sorted(k for k in keywords if k == keyword or k.startswith(keyword) and not (k[len(keyword)].isalnum() or k[len(keyword)] == "_"))


def scores(text: Column, dictionary: dict[str, list[str]], least: int = 1) -> Column:
    """array<struct<score, rank, label>> of labels with `least` hits, best first; of equal ones the earlier label.

    Every keyword counts by itself, so overlapping keywords count several times; occurrences of one keyword do not
    overlap. rank is the place in the array. The text is searched once for all keywords.
    """
    every = {_own(k) for keys in dictionary.values() for k in keys} - {""}
    kind = "array<struct<score:bigint,rank:int,label:string>>"
    if not every:
        return F.array().cast(kind)
    odd = {k for k in every if _meets_itself(k)}

    def of_label(own: Column, hits: Column, keys: list[str]) -> Column:
        wanted = [_own(k) for k in keys]
        plain = [x for k in wanted if k not in odd and k for x in standing(k, every)]
        once, more = sorted(set(plain)), sorted({x for x in plain if plain.count(x) > 1})
        n = F.size(F.filter(hits, lambda x: x.isin(once))) if once else F.lit(0)
        for x in more:  # a hit that stands for several keywords of a label
            n = n + (plain.count(x) - 1) * F.size(F.filter(hits, F.lit(x).__eq__))
        return sum((keyword_count(own, k) for k in wanted if k in odd), n)

    def counted(pair: Column) -> Column:
        rows = (F.struct((-of_label(pair.own, pair.hits, keys)).alias("negative"), F.lit(i).alias("ord"), F.lit(label).alias("label")) for i, (label, keys) in enumerate(dictionary.items()))
        return F.array(*rows)

    pair = lambda own: F.struct(own.alias("own"), found_keywords(own, sorted(every)).alias("hits"))
    hit = F.sort_array(F.filter(let(let(normalised(text), pair), counted), lambda s: -s.negative >= least))
    return F.transform(hit, lambda s, i: F.struct((-s.negative).cast("bigint").alias("score"), i.alias("rank"), s.label.alias("label")))


def primary_domain(text: Column, dictionary: dict[str, list[str]] | None = None) -> Column:
    return F.coalesce(F.get(scores(text, dictionary or DOMAINS), 0).label, F.lit(OTHER))


def top_tags(text: Column, section: Column, source: Column, dictionary: dict[str, list[str]], most: int = 10) -> Column:
    """array<string>: tags by their rank in the text (10 points down to 1, two hits needed), 5 points for the section, 3 for
    the source name; of equal ones those of the text come first, then the section's, then the source's."""
    t, s, f = scores(text, dictionary, 2), scores(section, dictionary), scores(source, dictionary)
    points = F.concat(
        F.transform(t, lambda x: F.struct((10 - F.least(x["rank"], F.lit(9))).alias("p"), x["rank"].alias("o"), x.label.alias("label"))),
        F.transform(s, lambda x: F.struct(F.lit(5).alias("p"), (x["rank"] + 1000).alias("o"), x.label.alias("label"))),
        F.transform(f, lambda x: F.struct(F.lit(3).alias("p"), (x["rank"] + 2000).alias("o"), x.label.alias("label"))),
    )

    def totals(every: Column) -> Column:
        def total(label: Column) -> Column:
            own = F.filter(every, lambda x: x.label == label)
            return F.struct(F.aggregate(own, F.lit(0), lambda a, x: a - x.p).alias("negative"), F.array_min(F.transform(own, lambda x: x.o)).alias("o"), label.alias("label"))

        return F.transform(F.array_distinct(F.transform(every, lambda x: x.label)), total)

    return F.slice(F.transform(F.sort_array(let(points, totals)), lambda x: x.label), 1, most)


def tag_nodes(nodes: DataFrame, dictionary: dict[str, list[str]], domains: dict[str, list[str]] | None = None, most: int = 10) -> DataFrame:
    """nodes (text, section, source) with tags and domain; null texts have no tags and the domain Khác."""
    return nodes.withColumn("tags", top_tags(F.col("text"), F.col("section"), F.col("source"), dictionary, most)).withColumn("domain", primary_domain(F.concat_ws(" ", "text", "source"), domains))


def available_tags(dictionary: dict[str, list[str]]) -> list[str]:
    """The labels of a dictionary in alphabetical order; dictionary.get(label, []) has a label's keywords."""
    return sorted(dictionary)


def tag_stats(nodes: DataFrame) -> DataFrame:
    """One row for each document of nodes (doc, tags, domain): sorted tags and domains and their numbers."""
    found = nodes.groupBy("doc").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("tags")))).alias("unique_tags"), F.array_sort(F.collect_set("domain")).alias("domains"))
    return found.withColumn("total_unique_tags", F.size("unique_tags")).withColumn("total_domains", F.size("domains"))
