"""Ordered rule lists and the CASE expressions built from them. Order decides: the first hit wins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip, text_or_empty

# Lists that must agree with the data producers, in their order of precedence.
SUBJECT_ALIASES = (
    ("物理", "物理类"), ("物理类", "物理类"), ("理科", "物理类"), ("理工", "物理类"),
    ("历史", "历史类"), ("历史类", "历史类"), ("文科", "历史类"), ("文史", "历史类"),
    ("综合改革", "综合改革"), ("综合", "综合改革"), ("不分文理", "综合改革"),
)
BATCH_ALIASES = (
    ("普通类本科", "普通类本科"), ("特殊类型招生控制线", "特殊类型招生控制线"),
    ("特殊类型控制线", "特殊类型招生控制线"), ("本科一批", "本科批"), ("本一", "本科批"),
    ("本二", "本科批"), ("本科二批", "本科批"), ("本科批", "本科批"), ("本科", "本科批"),
    ("专科批", "专科批"), ("高职专科", "专科批"), ("专科", "专科批"), ("提前批次", "提前批"),
    ("提前批", "提前批"), ("艺术本科", "艺术批"), ("体育本科", "体育批"),
)
SCHOOL_BATCH_ALIASES = (
    ("本科一批", "本科一批"), ("本科二批", "本科二批"), ("高职高专批", "高职高专批"),
    ("高职高专", "高职高专批"), ("普通类本科批次", "本科批"), ("本科批次平行志愿", "本科批"),
    ("本科批次", "本科批"), ("本科批", "本科批"), ("第一段", "本科批"), ("第1次志愿", "本科批"),
    ("普通类专科批次", "专科批"), ("专科批次平行志愿", "专科批"), ("专科批次", "专科批"),
    ("专科批", "专科批"), ("第二段", "专科批"), ("第2次志愿", "专科批"), ("第3次志愿", "专科批"),
    ("本科提前批次", "本科提前批"), ("本科提前批", "本科提前批"), ("提前批次", "本科提前批"),
)
CATEGORY_ALIASES = (
    ("普通类", "普通类"), ("普通", "普通类"), ("艺术类", "艺术类"),
    ("艺术", "艺术类"), ("体育类", "体育类"), ("体育", "体育类"),
)
PROVINCE_ALIASES = (
    ("江苏", ("江苏", "江苏省", "js", "jiangsu")),
    ("广东", ("广东", "广东省", "gd", "guangdong")),
    ("福建", ("福建", "福建省", "fj", "fujian")),
    ("河北", ("河北", "河北省", "hb", "hebei")),
)
PROVINCE_SUFFIXES = ("省", "市", "壮族自治区", "回族自治区", "维吾尔自治区", "自治区")
SUBJECTS = ("文科", "理科", "历史类", "物理类", "综合改革")
DEFAULT_CATEGORY = "普通类"
DEFAULT_BATCH = "本科批"
# Query mode of a province without rows (all others: mixed).
DEFAULT_QUERY_MODES = {
    "江苏": "score", "浙江": "score", "山东": "rank", "河南": "score",
    "广东": "mixed", "福建": "score", "河北": "score", "湖北": "unsupported_pdf_or_image",
}
# Access states from worst to best; unknown is not part of the order.
ACCESS_SEVERITY = (
    "verification_required", "waf_blocked", "connection_reset", "unsupported_archive",
    "unsupported_pdf", "partial", "available",
)
LEGACY_ACCESS = {"ok": "available", "unsupported_verification_required": "verification_required"}
VERIFICATION_MARKERS = ("验证码", "captcha", "人机验证", "安全验证")
DATA_CENTRE_HOST = "datacenter.haeea.cn"


def any_in(c: Column, words) -> Column:
    """True when the text contains one of the words (plain contains, no regex)."""
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(w)) for w in words])


def first_hit(c: Column, pairs, default: Column) -> Column:
    """Result of the first pair whose word is contained in the text."""
    word, result = pairs[0]
    case = F.when(F.contains(c, F.lit(word)), F.lit(result))
    for word, result in pairs[1:]:
        case = case.when(F.contains(c, F.lit(word)), F.lit(result))
    return case.otherwise(default)


def labelled(c: Column, labels: dict[str, str], default: Column) -> Column:
    """Exact lookup in a small fixed mapping."""
    case = None
    for key, value in labels.items():
        case = (F if case is None else case).when(c == key, F.lit(value))
    return case.otherwise(default)


def province_name(c: Column) -> Column:
    t = text_or_empty(c)

    def alias(v: Column) -> Column:
        case = None
        for name, keys in PROVINCE_ALIASES:
            case = (F if case is None else case).when(F.lower(v).isin(*keys), F.lit(name))
        return case

    bare = F.regexp_replace(t, "(" + "|".join(PROVINCE_SUFFIXES) + ")$", "")
    return F.coalesce(alias(t), alias(bare), bare)


def subject_name(c: Column, legacy: Column | None = None) -> Column:
    """Standard subject; with legacy the two old names are kept instead."""
    t = text_or_empty(c)
    modern = first_hit(t, SUBJECT_ALIASES, t)
    if legacy is None:
        return modern
    old = first_hit(t, (("文科", "文科"), ("理科", "理科")), t)
    return F.when(legacy, old).otherwise(modern)


def batch_name(c: Column) -> Column:
    t = text_or_empty(c)
    return first_hit(t, BATCH_ALIASES, t)


def school_batch_name(c: Column) -> Column:
    t = text_or_empty(c)
    return first_hit(t, SCHOOL_BATCH_ALIASES, t)


def category_name(c: Column) -> Column:
    t = text_or_empty(c)
    return first_hit(t, CATEGORY_ALIASES, t)


def subject_in_text(c: Column, legacy: Column | None = None) -> Column:
    """Subject named in a free text, null when there is none."""
    modern = F.when(any_in(c, ("历史", "文科")), "历史类").when(any_in(c, ("物理", "理科")), "物理类")
    if legacy is None:
        return modern
    old = F.when(F.contains(c, F.lit("文科")), "文科").when(F.contains(c, F.lit("理科")), "理科")
    return F.when(legacy, old).otherwise(modern)


def batch_from_context(given: Column, name: Column, title: Column, text: Column) -> Column:
    blob = F.concat_ws(" ", *[F.nullif(v, F.lit("")) for v in (name, title, text)])
    junior = F.contains(blob, F.lit("高职高专")) | (
        F.contains(blob, F.lit("专科")) & ~F.contains(blob, F.lit("本科"))
    )
    return F.coalesce(F.nullif(strip(given), F.lit("")), F.when(junior, "专科批").otherwise(DEFAULT_BATCH))


def subject_from_context(given: Column, name: Column, title: Column, text: Column, legacy: Column | None = None) -> Column:
    return F.coalesce(
        F.when(strip(given) != "", subject_name(given, legacy)),
        *[subject_in_text(F.coalesce(v, F.lit("")), legacy) for v in (name, title, text)],
    )


def valid_subject(c: Column) -> Column:
    return F.coalesce(strip(c).isin(*SUBJECTS), F.lit(False))


def default_query_mode(province: Column) -> Column:
    return labelled(province_name(province), DEFAULT_QUERY_MODES, F.lit("mixed"))


def access_status(c: Column) -> Column:
    """Standard access state of a free text."""
    t = F.lower(strip(c))
    known = t.isin(*ACCESS_SEVERITY, "unknown")
    return (
        F.when(F.coalesce(c, F.lit("")) == "", "available")
        .when(t.isin(*LEGACY_ACCESS), labelled(t, LEGACY_ACCESS, t))
        .when(known, t)
        .otherwise("partial")
    )


def access_severity(status: Column) -> Column:
    """0 is the worst state; a state outside the order comes last."""
    pos = F.array_position(F.array(*[F.lit(s) for s in ACCESS_SEVERITY]), status)
    return F.when(pos > 0, pos - 1).otherwise(F.lit(len(ACCESS_SEVERITY)).cast("long"))


def needs_verification(html: Column) -> Column:
    h = F.coalesce(html, F.lit(""))
    return any_in(h, VERIFICATION_MARKERS) | any_in(F.lower(h), VERIFICATION_MARKERS)


def source_access(page_url: Column, html: Column, attachment_count: Column) -> Column:
    """Whether a page can be read without a human: ok or unsupported_verification_required."""
    h = F.coalesce(html, F.lit(""))
    blocked = F.lit("unsupported_verification_required")
    return (
        F.when(attachment_count > 0, "ok")
        .when(F.contains(F.lower(F.coalesce(page_url, F.lit(""))), F.lit(DATA_CENTRE_HOST)), blocked)
        .when(h == "", "ok")
        .when(needs_verification(h), blocked)
        .when(F.contains(h, F.lit(DATA_CENTRE_HOST)) & F.contains(h, F.lit("投档")), blocked)
        .otherwise("ok")
    )


def clamp_limit(value: Column, default: int, maximum: int) -> Column:
    return F.when(value < 1, default).otherwise(F.least(value, F.lit(maximum)))


def request_error(
    year: Column, province: Column, subject: Column,
    min_score: Column, max_score: Column, rank_min: Column, rank_max: Column,
) -> Column:
    """First rule a request breaks, null for a good request."""
    return (
        F.when(~year.between(2000, 2030), "year")
        .when((text_or_empty(subject) != "") & ~valid_subject(subject), "subject_type")
        .when(min_score > max_score, "score_range")
        .when(rank_min > rank_max, "rank_range")
    )
