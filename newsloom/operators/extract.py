"""Page -> article.

``read_pages_job`` is the only Python-worker stage of the engine: it turns
markup into match counts, raw field texts, cleaned content and links. All
decisions on those values (is it an article, trimming, dates, rejects) are
column expressions, so they stay visible to Catalyst.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import markup
from newsloom.functions.dates import parse_date, zero_date
from newsloom.functions.page_links import resolve_link
from newsloom.functions.text import trim_field
from newsloom.operators.store import missing_required

FIELDS = ("title", "description", "content", "author", "date", "thumbnail")
TEXT_MODES = ("first_text", "first_child")

EXTRACTED = pa.schema(
    [
        ("n_content", pa.int32()),
        ("n_title", pa.int32()),
        ("n_date", pa.int32()),
        ("title_raw", pa.string()),
        ("date_raw", pa.string()),
        ("description_raw", pa.string()),
        ("author_raw", pa.string()),
        ("content", pa.string()),
        ("links", pa.list_(pa.string())),
        ("warnings", pa.list_(pa.string())),
        ("parse_error", pa.string()),
    ]
)
EXTRACTED_DDL = (
    "n_content int, n_title int, n_date int, title_raw string, date_raw string, "
    "description_raw string, author_raw string, content string, "
    "links array<string>, warnings array<string>, parse_error string"
)
OUTPUT_BYTES = 16 << 20


def _first_text(node: markup.Node) -> str | None:
    pending: list = list(reversed(node.children))
    while pending:
        child = pending.pop()
        if isinstance(child, markup.Node):
            pending.extend(reversed(child.children))
        elif not isinstance(child, markup.Comment):
            return child
    return None


def _node_text(node: markup.Node, mode: str, through_link: bool = False) -> str | None:
    """First text below the node, or what its first child is; None when empty."""
    if mode == "first_text":
        return _first_text(node)
    first = node.children[0] if node.children else None
    if not isinstance(first, markup.Node):
        return first
    first.expand()
    if through_link and first.tag == "a":
        return _node_text(first, mode)
    return first.tag


def _clean_content(content: markup.Node, page_url: str, warnings: list[str]) -> str:
    content.expand_all()
    for dropped in [n for n in content.walk() if n.tag in ("aside", "script")]:
        if dropped.parent is not None:
            dropped.detach()
    for node in content.walk():
        name = {"a": "href", "img": "src"}.get(node.tag)
        if name in node.attrs:
            try:
                node.attrs = {**node.attrs, name: resolve_link(page_url, node.attrs[name])}
            except ValueError as problem:
                warnings.append(str(problem))
    return markup.inner_markup(content)


def _read_one(url: str, source: str, selectors: dict, mode: str, keep_links: bool) -> dict:
    page = markup.Page(source)
    out = {"warnings": []}
    if keep_links:
        out["links"] = [n.attrs["href"] for n in page.tagged("a") if "href" in n.attrs]
    if not selectors:
        return out
    found = {f: page.select(selectors[f]) for f in FIELDS if selectors.get(f)}
    for field in ("content", "title", "date"):
        out[f"n_{field}"] = len(found.get(field, ()))
    if (out["n_content"], out["n_title"]) != (1, 1) or not out["n_date"]:
        return out
    # description and author are read before the content changes, title and date after
    if found.get("description"):
        out["description_raw"] = _node_text(found["description"][0], mode)
    if found.get("author"):
        out["author_raw"] = _node_text(found["author"][0], mode, through_link=True)
    content = found["content"][0]
    thumbnail = (found.get("thumbnail") or [None])[0]
    if thumbnail is not None and thumbnail.tag == "img" and thumbnail is not content:
        thumbnail.detach()
        thumbnail.parent = content
        content.children.insert(0, thumbnail)
    out["content"] = _clean_content(content, url, out["warnings"])
    out["title_raw"] = _node_text(found["title"][0], mode)
    out["date_raw"] = _node_text(found["date"][0], mode)
    return out


def read_pages_job(
    pages: DataFrame,
    keys: tuple[str, ...] = ("page_id", "website", "url"),
    text_mode: str = "first_text",
    keep_links: bool = True,
) -> DataFrame:
    """Run the page-reading job.

    ``pages`` holds the key columns, ``html`` and, unless only links are wanted,
    ``sel`` (struct of selector texts). Only these columns cross into Python; the
    keys come back unchanged.
    One broken page never fails a task: it yields a row with ``parse_error``.
    """
    if text_mode not in TEXT_MODES:
        raise ValueError(f"text_mode must be one of {TEXT_MODES}")
    has_selectors = "sel" in pages.columns
    selector_columns = [
        F.col(f"sel.{f}").alias(f"sel_{f}") for f in FIELDS if has_selectors
    ]
    needed = pages.select(*keys, "html", *selector_columns)
    key_ddl = ", ".join(f"{k} {needed.schema[k].dataType.simpleString()}" for k in keys)

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(n) for n in batch.schema.names}
            selector_lists = {f: columns[f"sel_{f}"] for f in FIELDS if has_selectors}
            rows: list[dict] = []
            done, size = 0, 0

            def flush(upto: int) -> pa.RecordBatch:
                kept = [columns[k].slice(done, upto - done) for k in keys]
                made = [pa.array([r.get(f.name) for r in rows], f.type) for f in EXTRACTED]
                return pa.RecordBatch.from_arrays(kept + made, names=[*keys, *EXTRACTED.names])

            for i in range(batch.num_rows):
                url, source = columns["url"][i].as_py(), columns["html"][i].as_py()
                selectors = {f: c[i].as_py() for f, c in selector_lists.items()}
                try:
                    row = _read_one(url or "", source or "", selectors, text_mode, keep_links)
                except Exception as problem:  # whatever a page does, it costs that page alone
                    row = {"parse_error": f"{type(problem).__name__}: {problem}"}
                rows.append(row)
                size += len(row.get("content") or "")
                if size > OUTPUT_BYTES:
                    yield flush(i + 1)
                    rows, done, size = [], i + 1, 0
            if rows:
                yield flush(batch.num_rows)

    return needed.mapInArrow(job, f"{key_ddl}, {EXTRACTED_DDL}")


def is_article() -> Column:
    """Exactly one content, exactly one title, at least one date."""
    return (F.col("n_content") == 1) & (F.col("n_title") == 1) & (F.col("n_date") >= 1)


def to_articles(
    extracted: DataFrame, on_bad_date: str = "reject", layouts: list[tuple[str, str]] | None = None
) -> DataFrame:
    """Trim, parse the date, and say for every page why it is no article.

    Needs ``date_pattern`` and ``date_rewrite`` next to the extracted columns, which
    ``layouts`` lists where they are few.
    ``reason`` is null for a good article; ``on_bad_date="zero_date"`` stores
    0001-01-01 instead of rejecting and leaves a warning.
    """
    if on_bad_date not in ("reject", "zero_date"):
        raise ValueError("on_bad_date must be 'reject' or 'zero_date'")
    title, date_text = trim_field(F.col("title_raw")), trim_field(F.col("date_raw"))
    parsed = extracted.withColumn(
        "date", parse_date(date_text, F.col("date_pattern"), F.col("date_rewrite"), layouts)
    )
    bad_date = date_text.isNotNull() & F.col("date").isNull()
    reason = (
        F.when(F.col("parse_error").isNotNull(), "parse_error")
        .when(~is_article(), "not_article")
        .when(title.isNull(), "empty_title")
        .when(date_text.isNull(), "empty_date")
    )
    detail = (
        F.when(F.col("parse_error").isNotNull(), F.col("parse_error"))
        .when(
            ~is_article(),
            F.format_string(
                "content_matches=%d title_matches=%d date_matches=%d", "n_content", "n_title", "n_date"
            ),
        )
        .when(bad_date, date_text)
    )
    date, warnings = F.col("date"), F.coalesce("warnings", F.array().cast("array<string>"))
    if on_bad_date == "reject":
        reason = reason.when(bad_date, "bad_date")
    else:
        date = F.when(bad_date, zero_date()).otherwise(date)
        note = F.concat(F.lit("bad_date: "), date_text)
        warnings = F.when(bad_date, F.concat(warnings, F.array(note))).otherwise(warnings)
    articles = parsed.select(
        "page_id",
        "website",
        "url",
        title.alias("title"),
        trim_field(F.col("description_raw")).alias("description"),
        "content",
        trim_field(F.col("author_raw")).alias("author"),
        date.alias("date"),
        reason.alias("reason"),
        detail.alias("detail"),
        warnings.alias("warnings"),
        *(["links"] if "links" in extracted.columns else []),
    )
    return articles.withColumn("reason", F.coalesce("reason", missing_required()))
