"""Record type, year, category, subject and batch from announcement titles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import DEFAULT_BATCH, any_in
from .text import text_or_empty

# Words in titles of the record types, in their order.
RANK_WORDS = ("逐分段", "一分一段", "分段统计", "高考成绩分段")
CONTROL_WORDS = ("录取控制分数线", "第一阶段录取控制分数线", "招生第一阶段录取控制分数线")
NOT_CONTROL_WORDS = ("投档线", "平行志愿", "征求志愿", "提前批次投档", "本科批次平行志愿", "专科批次平行志愿")
SCHOOL_WORDS = (
    "体育类本科", "艺术类本科", "体育类本科批次", "艺术类本科批次", "投档线", "平行投档分数线", "投档情况表", "投档情况",
    "投档情况统计", "平行志愿投档", "投档分数线表", "投档分数线", "投档最低分", "院校专业组", "正式投档",
)
DISCOVERY_WORDS = {
    "control": CONTROL_WORDS,
    "rank": ("逐分段统计表", "逐分段", "分段统计", "一分一段", "高考成绩分段", "第一阶段逐分段"),
    "school": (
        "普通类本科批次平行志愿投档线", "普通类专科批次平行志愿投档线", "专科批次平行志愿投档线", "本科提前批次投档线",
        "体育类本科批次平行志愿投档线", "体育类本科", "艺术类本科批次平行志愿投档线", "艺术类本科",
    ),
    "major": ("专业录取分数线", "专业录取情况"),
}
RECORD_TYPES = ("control", "rank", "school", "major")
CHINESE_YEARS = {2024: "二〇二四", 2023: "二〇二三", 2022: "二〇二二", 2021: "二〇二一"}

# Title rules per province as (result, words of which one must occur, words that must not).
_ART = ("音乐类", "美术与设计类", "舞蹈类", "播音与主持类", "表(导)演类", "书法类", "戏曲类")
_ORDINARY = ("普通类", "平行志愿", "投档情况", "投档线", "院校专业组", "本科批", "专科批")
_LATER_CATEGORY = (
    ("普通类", ("普通类",), ()), ("unsupported", ("艺术", "美术", "音乐", "体育"), ()), ("普通类", _ORDINARY, ()),
)
_LATER_SUBJECT = (("物理类", ("物理科目",), ()), ("物理类", ("物理",), ("历史",)), ("历史类", ("历史",), ()))
_LATER_BATCH = (("专科批", ("专科批", "高职"), ()), ("专科批", ("专科",), ("本科",)))
CATEGORY_RULES = {
    "fujian": (("普通类", ("普通类",), ()), ("体育类", ("体育",), ()), ("艺术类", (*_ART, "艺术"), ())),
    "hebei": (
        ("对口类", ("对口", "单招", "专升本"), ()), ("普通类", ("普通类", "普通高校招生"), ()), ("体育类", ("体育",), ()),
        ("艺术类", (*_ART, "艺术类"), ()), ("艺术类", ("艺术",), ("普通",)), ("艺术类", ("音乐表演", "美术与设计", "舞蹈", "播音"), ()),
    ),
    "guangdong": (("普通类", ("普通类",), ()), ("体育类", ("体育类",), ()), ("艺术类", (*_ART, "艺术类"), ())),
    "hubei": (
        ("普通类", ("普通类", "普通批"), ()), ("unsupported", ("艺术", "美术", "音乐", "体育"), ()),
        ("普通类", ("平行志愿", "投档情况", "投档线", "院校专业组", "本科普通批", "高职高专普通批"), ()),
        ("unsupported", ("技能高考", "单招", "对口", "征集志愿"), ()),
    ),
    "hunan": _LATER_CATEGORY, "liaoning": _LATER_CATEGORY, "chongqing": _LATER_CATEGORY,
}
SUBJECT_RULES = {
    "fujian": (("物理类", ("物理科目组",), ()), ("物理类", ("物理",), ("历史",)), ("历史类", ("历史",), ())),
    "hebei": (("物理类", ("物理科目组合",), ()), ("物理类", ("物理",), ("历史",)), ("历史类", ("历史",), ())),
    "hubei": (("物理类", ("首选物理", "物理科目"), ()), ("物理类", ("物理",), ("历史",)), ("历史类", ("历史",), ())),
    "hunan": _LATER_SUBJECT, "liaoning": _LATER_SUBJECT, "chongqing": _LATER_SUBJECT,
}
BATCH_RULES = {
    "fujian": (
        ("专科批", ("高职专科批", "高职（专科）批", "高职(专科)批"), ()), ("专科批", ("专科批",), ("本科批",)), ("专科批", ("专科",), ("本科",)),
    ),
    "hebei": (("专科批", ("专科批",), ()), ("专科批", ("专科",), ("本科",))),
    "hubei": (("专科批", ("高职高专", "专科批"), ()), ("专科批", ("专科",), ("本科",))),
    "hunan": _LATER_BATCH, "liaoning": _LATER_BATCH, "chongqing": _LATER_BATCH,
}


def is_control_title(title: Column) -> Column:
    return ~any_in(title, NOT_CONTROL_WORDS) & any_in(title, CONTROL_WORDS)


def record_type(title: Column) -> Column:
    return (
        F.when(any_in(title, RANK_WORDS), "rank")
        .when(any_in(title, NOT_CONTROL_WORDS), F.when(any_in(title, ("投档线", "投档情况")), "school").otherwise("unknown"))
        .when(any_in(title, CONTROL_WORDS), "control")
        .when(any_in(title, SCHOOL_WORDS), "school")
        .when(F.contains(title, F.lit("专业录取")), "major")
        .otherwise("unknown")
    )


def _joined(title: Column, context: Column | None) -> Column:
    parts = [title] if context is None else [context, title]
    return F.concat_ws(" ", *[F.nullif(F.coalesce(p, F.lit("")), F.lit("")) for p in parts])


def category_from_title(title: Column, context: Column | None = None) -> Column:
    """The title itself decides before the title of the page it came from."""
    own, text = F.coalesce(title, F.lit("")), _joined(title, context)
    return (
        F.when(any_in(own, ("艺术类",)), "艺术类").when(any_in(own, ("体育类",)), "体育类")
        .when(any_in(text, ("艺术类",)), "艺术类")
        .when(any_in(text, ("体育类",)) | (any_in(text, ("体育",)) & any_in(text, ("本科",))), "体育类")
        .otherwise("普通类")
    )


def batch_from_title(title: Column, context: Column | None = None) -> Column:
    text = _joined(title, context)
    return (
        F.when(any_in(text, ("本科一批",)), "本科一批").when(any_in(text, ("本科二批",)), "本科二批")
        .when(any_in(text, ("高职高专",)), "高职高专批").when(any_in(text, ("第一段",)), "本科批")
        .when(any_in(text, ("第二段",)), "专科批").when(any_in(text, ("第1次",)), "本科批")
        .when(any_in(text, ("第2次", "第3次")), "专科批")
        .when(any_in(text, ("专科",)) & any_in(text, ("批",)), "专科批")
        .when(any_in(text, ("提前",)) & any_in(text, ("批",)), "本科提前批")
        .otherwise(DEFAULT_BATCH)
    )


def subject_from_title(title: Column, legacy: Column | None = None) -> Column:
    t = F.coalesce(title, F.lit(""))
    modern = (
        F.when(any_in(t, ("历史科目组", "历史等科目", "历史类", "文科")), "历史类")
        .when(any_in(t, ("物理科目组", "物理等科目", "物理类", "理科")), "物理类")
        .when(any_in(t, ("历史",)) & ~any_in(t, ("物理",)), "历史类")
        .when(any_in(t, ("物理",)), "物理类")
    )
    if legacy is None:
        return modern
    old = F.when(any_in(t, ("文科",)), "文科").when(any_in(t, ("理科",)), "理科")
    return F.when(legacy, old).otherwise(modern)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*", ""), r"^[^?#]*", 0)


def announcement_year(title: Column, url: Column, years: Sequence[int]) -> Column:
    """First of the requested years named in the title (digits or Chinese) or in the path of the page."""
    path = url_path(url)
    case = None
    for year in years:
        names = [str(year)] + ([CHINESE_YEARS[year]] if year in CHINESE_YEARS else [])
        hit = any_in(title, names) | any_in(path, (f"/{year}-", f"/{year}/"))
        case = (F if case is None else case).when(hit, F.lit(year))
    return case


def keyword_list(data_type: str | None = None, extra: str | None = None) -> list[str]:
    """Extra keyword first, then those of the type (or of all types), without repeats."""
    words = [extra.strip()] if extra and extra.strip() else []
    for kind in ([data_type] if data_type else RECORD_TYPES):
        words.extend(DISCOVERY_WORDS.get(kind, ()))
    return list(dict.fromkeys(words))


def matched_keyword(title: Column, words: Sequence[str]) -> Column:
    return F.get(F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(title, w)), F.lit(0))


def _rule_case(text: Column, rules) -> Column:
    case = None
    for result, words, absent in rules:
        hit = any_in(text, words)
        if absent:
            hit = hit & ~any_in(text, absent)
        case = (F if case is None else case).when(hit, F.lit(result))
    return case


def _per_province(slug: Column, text: Column, rule_sets: dict) -> Column:
    case = None
    shared: dict = {}
    for name, rules in rule_sets.items():
        shared.setdefault(rules, []).append(name)
    for rules, names in shared.items():
        case = (F if case is None else case).when(slug.isin(*names), _rule_case(text, rules))
    return case


def province_category(slug: Column, title: Column) -> Column:
    """Category by the rules of the province; null when they do not decide or there are none."""
    return _per_province(slug, F.coalesce(title, F.lit("")), CATEGORY_RULES)


def province_subject(slug: Column, title: Column) -> Column:
    return _per_province(slug, F.coalesce(title, F.lit("")), SUBJECT_RULES)


def province_batch(slug: Column, title: Column, context: Column | None = None) -> Column:
    """Batch by the rules of the province; null for provinces without batch rules."""
    found = _per_province(slug, _joined(title, context), BATCH_RULES)
    return F.when(slug.isin(*BATCH_RULES), F.coalesce(found, F.lit(DEFAULT_BATCH)))


def province_metadata(slug: Column, title: Column, context: Column) -> tuple[Column, Column]:
    """(category, batch): rules on the title, rules on its page title, then the general rules."""
    ruled = F.coalesce(province_category(slug, title), F.when(text_or_empty(context) != "", province_category(slug, context)))
    category = F.coalesce(F.when(ruled == "unsupported", "艺术类").otherwise(ruled), category_from_title(title, context))
    return category, F.coalesce(province_batch(slug, title, context), batch_from_title(title, context))


def importable(slug: Column, category: Column) -> Column:
    """Provinces with rules take ordinary rows only, others take all."""
    return ~slug.isin(*CATEGORY_RULES) | F.coalesce(category == "普通类", F.lit(False))


def record_type_rules() -> list[tuple[str, tuple[tuple[str, ...], ...]]]:
    """The rules of ``record_type`` as an ordered list: a result, and groups of words of each of which one must occur."""
    return [
        ("rank", (RANK_WORDS,)), ("school", (("投档线", "投档情况"), NOT_CONTROL_WORDS)), ("unknown", (NOT_CONTROL_WORDS,)), ("control", (CONTROL_WORDS,)),
        ("school", (SCHOOL_WORDS,)), ("major", (("专业录取",),)), ("unknown", ()),
    ]
