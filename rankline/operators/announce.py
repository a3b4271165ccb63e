"""Links of pages to announcements, attachments, discovery tables and import outcomes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules, titles
from ..functions.text import file_name, file_suffix, strip, text_or_empty
from ..sources.html import links_of_pages
from .search import first_per
from .settle import settled

# Extensions, words of download links, and parts of site furniture.
DOWNLOAD_EXTENSIONS = (".xlsx", ".xls", ".pdf", ".csv", ".zip")
DOWNLOAD_WORDS = r"(?i)下载|excel|xlsx|xls|pdf|投档|录取|一分一段"
ATTACHMENT_EXTENSIONS = (".xlsx", ".xls", ".pdf", ".rar", ".zip", ".jpg", ".jpeg", ".png")
DATA_EXTENSIONS = (".xlsx", ".xls", ".pdf", ".rar", ".zip")
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png")
UI_MARKERS = ("icon-", "logo", "resource-", "print.png", "wx.jpg", "school-logo", "/images/")
# Detail pages per province as regular expressions on the lower-case URL after its host.
DETAIL_PAGES = {
    "jiangsu": r"^[^?#]*/index_zkxx/\d{4}-\d{2}-\d{2}/\d+\.html([?#]|$)", "fujian": r"^[^?#]*/gkptgkgsgg/[^?#]*\.j?html([?#]|$)",
    "guangdong": r"^[^?#]*/content/post_", "hebei": r"^[^?#]*/html/xxgl/tzgg/[^?#]*\.html([?#]|$)", "henan": r"^[^?#]*show\.asp.*id=",
    "hubei": r"^[^?#]*/html/(apccglq|gzgzbl)/[^?#]*\.html([?#]|$)", "shandong": r"^[^?#]*newsinfo\.aspx.*newsid=", "zhejiang": r"^[^?#]*/art/[^?#]*\.html([?#]|$)",
}
ANY_DETAIL_PAGE = r"^[^?#]*\.(html|htm|shtml|jhtml)([?#]|$)"


def folded(path: Column) -> Column:
    """Absolute path without empty and dot segments; ``..`` takes away the segment before it, at the root nothing."""
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    step = lambda kept, x: F.when(x == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))).when(x == ".", kept).otherwise(F.concat(kept, F.array(x)))
    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    end = F.when((F.size(kept) > 0) & path.rlike(r"/\.{0,2}$"), "/").otherwise("")
    return F.concat(F.lit("/"), F.array_join(kept, "/"), end)


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute URL of a link; dot segments are folded."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*:)", 1)
    root = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)", 1)
    path = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/]*", "")
    tail = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    own = F.regexp_extract(href, r"^([^?#]*)", 1)
    whole = F.when(F.startswith(href, F.lit("/")), own).otherwise(F.concat(F.regexp_replace(F.when(path == "", F.lit("/")).otherwise(path), r"[^/]*$", ""), own))
    return (
        F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), href).when(F.startswith(href, F.lit("//")), F.concat(scheme, href))
        .when(own == "", F.concat(F.regexp_replace(base, F.when(F.startswith(href, F.lit("?")), r"[?#].*$").otherwise(r"#.*$"), F.lit("")), href))
        .otherwise(F.concat(root, folded(whole), tail))
    )


def links(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Links of every page in order: absolute URL and text. Empty, fragment and script links are left out."""
    return absolute_links(links_of_pages(pages, page, url, html), page)


def absolute_links(tags: DataFrame, page: str) -> DataFrame:
    """The same from parsed links and images (page, base_url, tag_no, tag, href, text)."""
    parts = tags.where("tag = 'a'").withColumnRenamed("tag_no", "link_no")
    kept = parts.where("href <> '' AND NOT startswith(href, '#') AND NOT startswith(lower(href), 'javascript:')")
    return settled(kept.select(page, "link_no", resolve_url(F.col("base_url"), F.col("href")).alias("url"), "text"))


def _extension(path: Column, allowed: Sequence[str]) -> Column:
    case = None
    for ext in allowed:
        case = (F if case is None else case).when(F.endswith(path, F.lit(ext)), F.lit(ext))
    return case


def download_links(found: DataFrame, page: str = "page_id") -> DataFrame:
    """Links to data files by extension or by words; the first link per URL of a page counts, without extension .xlsx is assumed."""
    path = F.lower(titles.url_path(F.col("url")))
    rows = settled(settled(found.withColumn("path", path)).withColumn("ext", _extension(F.col("path"), DOWNLOAD_EXTENSIONS)))
    rows = rows.where(F.col("ext").isNotNull() | F.col("text").rlike(DOWNLOAD_WORDS) | F.col("path").rlike(DOWNLOAD_WORDS))
    return first_per(rows, [page, "url"], ["link_no"]).select(page, "url", "text", F.coalesce("ext", F.lit(".xlsx")).alias("ext"))


def _query_suffix(url: Column) -> Column:
    """Suffix of the file that a download script is asked for in its query: of ``filename``, else of ``showname``, else .xls if there is a
    ``filename``; null without these."""
    raw = [F.nullif(F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1), F.lit("")) for name in ("filename", "showname")]
    found = [_extension(F.lower(F.coalesce(F.try_url_decode(r), r)), (".xlsx", ".xls")) for r in raw]
    return F.coalesce(*found, F.when(raw[0].isNotNull(), ".xls"))


def attachments(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Attachments of every page from links and images: title, URL, file type; first per URL."""
    return attached_files(links_of_pages(pages, page, url, html), page)


def attached_files(tags: DataFrame, page: str) -> DataFrame:
    """The same from parsed links and images (page, base_url, tag_no, tag, href, text)."""
    tags = tags.withColumn("text", F.when(F.col("tag") == "a", F.col("text")).otherwise(F.lit("")))
    rows = tags.where("href <> '' AND NOT startswith(lower(href), 'javascript:')").withColumn("target", resolve_url(F.col("base_url"), F.col("href")))
    rows = settled(settled(rows).withColumn("path", titles.url_path(F.col("target"))))
    script = F.contains(F.lower("target"), F.lit("downfile.jsp"))
    from_query = F.when(script, _query_suffix(F.col("target")))
    rows = settled(rows.withColumn("ext", F.coalesce(_extension(F.lower("path"), ATTACHMENT_EXTENSIONS), from_query))).where("ext IS NOT NULL")
    title = F.coalesce(F.nullif("text", F.lit("")), F.nullif(file_name(F.col("path")), F.lit("")), F.lit("attachment"))
    kind = F.regexp_replace(F.when(F.col("ext") == ".jpeg", ".jpg").otherwise(F.col("ext")), r"^\.", "")
    return first_per(rows, [page, "target"], ["tag_no"]).select(page, "tag_no", title.alias("title"), F.col("target").alias("url"), kind.alias("file_type"))


def embedded_records(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Records of a page in <record><![CDATA[...]]></record> blocks: title and absolute URL; first per URL."""
    blocks = pages.select(page, F.col(url).alias("base_url"), F.posexplode(F.regexp_extract_all(html, F.lit(r"(?s)<record><!\[CDATA\[(.*?)\]\]></record>"), F.lit(1))).alias("record_no", "b"))
    rows = blocks.withColumn("href", strip(F.regexp_extract("b", r'href="([^"]+)"', 1)))
    rows = rows.where("href <> '' AND NOT startswith(lower(href), 'javascript:') AND NOT contains(href, 'weixin.qq.com')")
    rows = rows.withColumn("page_url", resolve_url(F.col("base_url"), F.col("href")))
    title = F.coalesce(F.nullif(strip(F.regexp_extract("b", r'title="([^"]+)"', 1)), F.lit("")), F.col("page_url"))
    return first_per(rows.withColumn("title", title), [page, "page_url"], ["record_no"]).select(page, "title", "page_url")


def is_detail_page(slug: Column, url: Column) -> Column:
    rest = F.regexp_replace(F.lower(url), r"^[a-z][a-z0-9+.\-]*://[^/?#]*", "")
    case = None
    for name, pattern in DETAIL_PAGES.items():
        case = (F if case is None else case).when(slug == name, rest.rlike(pattern))
    return case.otherwise(rest.rlike(ANY_DETAIL_PAGE))


def announcements(found: DataFrame, years: Sequence[int], words: Sequence[str], source: str = "slug") -> DataFrame:
    """Links (slug, link_no, url, text) that are detail pages of a requested year with a keyword; first per URL."""
    rows = found.withColumn("title", strip(F.col("text"))).where((F.col("title") != "") & is_detail_page(F.col(source), F.col("url")))
    rows = settled(rows.withColumn("year", titles.announcement_year(F.col("title"), F.col("url"), years)).withColumn("matched_keyword", titles.matched_keyword(F.col("title"), words)))
    rows = rows.where("year IS NOT NULL AND matched_keyword IS NOT NULL")
    return first_per(rows, [source, "url"], ["link_no"]).select(source, "title", F.col("url").alias("page_url"), "matched_keyword", "year")


def data_attachments(rows: DataFrame, page: str, record_type: str | Column | None = None) -> DataFrame:
    """Attachments that are data files (images too for control lines) and no site furniture; first per URL."""
    rows = settled(rows.withColumn("_path", F.lower(titles.url_path(F.col("url")))))
    path = F.col("_path")
    ext = F.regexp_extract(path, r"(\.[^./]+)$", 1)
    from_query = _query_suffix(F.col("url"))
    ext = F.when(~ext.isin(*DATA_EXTENSIONS, *IMAGE_EXTENSIONS) & F.contains(F.lower("url"), F.lit("downfile.jsp")), F.coalesce(from_query, ext)).otherwise(ext)
    kind = record_type if isinstance(record_type, Column) else F.lit(record_type)
    allowed = ext.isin(*DATA_EXTENSIONS) | (F.coalesce(kind == "control", F.lit(False)) & ext.isin(*IMAGE_EXTENSIONS))
    furniture = rules.any_in(path, UI_MARKERS) | rules.any_in(F.lower(F.coalesce("title", F.lit(""))), UI_MARKERS)
    good = rows.where((text_or_empty(F.col("url")) != "") & allowed & ~furniture)
    return first_per(good.drop("_path"), [page, "url"], ["tag_no"])


def image_attachments(rows: DataFrame) -> DataFrame:
    """Uploaded table images of a page (for text recognition)."""
    url = F.lower("url")
    return rows.where(_extension(url, (".png", ".jpg", ".jpeg")).isNotNull() & ~rules.any_in(url, UI_MARKERS) & rules.any_in(url, ("uploadfile", "/files/")))


def discovery_table(found: DataFrame, files: DataFrame) -> DataFrame:
    """Announcements with type, category, batch and their data attachments in order. ``files``: page_url, tag_no, title, url, file_type."""
    c = F.col
    typed = found.withColumn("suggested_type", titles.record_type(c("title")))
    category, batch = titles.province_metadata(c("slug"), c("title"), F.lit(None).cast("string"))
    kept = data_attachments(files.join(typed.select("page_url", "suggested_type"), "page_url"), "page_url", c("suggested_type"))
    lists = kept.groupBy("page_url").agg(F.array_sort(F.collect_list(F.struct("tag_no", "title", "url", "file_type"))).alias("attachments"))
    return typed.join(lists, "page_url", "left").withColumns({"admission_category": category, "batch": batch})


def filter_sources(sources: DataFrame, record_type: str | None = None, keyword: str | None = None) -> DataFrame:
    if record_type:
        sources = sources.where(F.col("suggested_type") == record_type)
    if keyword and keyword.strip():
        sources = sources.where(F.contains("title", F.lit(keyword.strip())))
    return sources


def route(path: Column, record_type: Column) -> tuple[Column, Column]:
    """(route, reason) of a file by extension and record type."""
    ext = file_suffix(path)
    page, paper, sheet = ext.isin(".html", ".htm"), ext == ".pdf", ext.isin(".xlsx", ".xls")
    known = F.when(sheet, "excel").when(page & record_type.isin("control", "rank"), "html").when(paper & record_type.isin("school", "control", "rank"), "pdf")
    reason = (
        F.when(known.isNotNull(), F.lit(None).cast("string")).when(ext == ".doc", "unsupported document").when(ext == ".rar", "unpack the archive first")
        .when(page, "html holds control and rank only").when(paper, "pdf holds school, control and rank only")
        .when(ext.isin(".jpg", ".jpeg", ".png", ".gif"), "image needs text recognition").otherwise("unknown file type")
    )
    return F.coalesce(known, F.when(ext.isin(".jpg", ".jpeg", ".png", ".gif"), "download_only").otherwise("unsupported")), reason


def import_outcomes(downloads: DataFrame, record_type: str, *, enable_ocr: bool = False) -> DataFrame:
    """Outcome per downloaded file by the first rule that fits, null for items that are not imported at all.

    Input: status, path, exists, importable, ocr, kind, looks_like_school, slug, title, corrupted,
    gate_passed, inserted, skipped_rows, failed_rows. ``kind_prio`` orders attachments before pages
    for control and rank imports.
    """
    c = F.col
    ext = file_suffix(c("path"))
    image = ext.isin(".jpg", ".jpeg", ".png")
    by_ocr = F.lit(enable_ocr) & F.coalesce(c("ocr"), F.lit(False)) & image
    importable = ext.isin(".xlsx", ".xls", ".html", ".htm", ".pdf")
    category, _ = titles.province_metadata(c("slug"), c("title"), F.lit(None).cast("string"))
    loaded = (
        F.when(c("inserted") > 0, "imported").when(c("failed_rows") > 0, F.when(by_ocr, "ocr_failed").otherwise("failed"))
        .otherwise(F.when(by_ocr, "ocr_skipped").otherwise("skipped"))
    )
    state = F.when(c("status").isNull() | (c("status") == ""), "available").otherwise(c("status"))
    outcome = (
        F.when(rules.access_status(state) == "verification_required", None).when(c("status") == "failed", "failed")
        .when(~F.coalesce(c("status").isin("downloaded", "skipped"), F.lit(False)), None).when(text_or_empty(c("path")) == "", None).when(~c("exists"), "failed")
        .when((c("importable") == F.lit(False)) | ((image | (ext == ".gif")) & ~by_ocr), "downloaded_not_imported").when(~importable & ~by_ocr, "skipped")
        .when(F.lit(record_type == "control") & c("looks_like_school"), "skipped_wrong_type")
        .when(F.lit(record_type == "school") & ~titles.importable(c("slug"), category), "skipped_unsupported_category")
        .when(by_ocr & ~c("gate_passed"), "downloaded_not_imported").when(by_ocr & c("corrupted"), "skipped_corrupted_image").otherwise(loaded)
    )
    prio = F.when(c("kind") == "attachment", 0).when(c("kind") == "page_html", 1).otherwise(2)
    return downloads.withColumns({"outcome": outcome, "kind_prio": prio if record_type in ("control", "rank") else F.lit(0)})


def direct_attachment(title: Column, url: Column) -> Column:
    """Attachment record of a link configured by hand."""
    path = F.lower(titles.url_path(url))
    kind = (
        F.when(_extension(path, (".xlsx", ".xls")).isNotNull(), "excel").when(F.endswith(path, F.lit(".pdf")), "pdf")
        .when(F.endswith(path, F.lit(".zip")), "zip").otherwise("unknown")
    )
    return F.struct(title.alias("title"), url.alias("url"), kind.alias("file_type"))
