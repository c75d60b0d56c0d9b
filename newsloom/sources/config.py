"""Site and feed configuration: YAML on the driver -> validated ``sites`` table.

Everything that can be wrong is reported here, before any job starts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.dates import translate_layout
from newsloom.functions.markup import compile_selector

# Accepted names.
STORE_DRIVERS = ("parquet",)
FEED_TYPES = ("rss", "atom")
REQUIRED_SELECTORS = ("title", "content", "date")
SELECTORS = ("title", "description", "content", "author", "date", "thumbnail")

# Rules of all sites, in bytes, up to which their table is broadcast.
BROADCAST_BYTES = 1 << 20

SITES_DDL = (
    "website string, start_point string, "
    "sel struct<title:string,description:string,content:string,author:string,"
    "date:string,thumbnail:string>, "
    "date_pattern string, date_rewrite string, max_visits int, "
    "ignore_all boolean, listed_keys array<string>, restrict string, exclude string"
)


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class Site:
    website: str
    start_point: str
    selectors: dict[str, str]
    date_format: str
    max_visits: int = 0
    ignore_all: bool | None = None
    listed_keys: tuple[str, ...] = ()
    restrict: str | None = None
    exclude: str | None = None
    default_year: int | None = None

    def __post_init__(self):
        who = f"site {self.website!r}"
        if not self.website or not isinstance(self.website, str):
            raise ConfigError("every site needs an identifier")
        if not re.match(r"https?://[^/?#\s]+(?:[/?#]\S*)?$", self.start_point or "", re.I):
            raise ConfigError(
                f"{who} has the start point {self.start_point!r}, which is no http or https URL"
            )
        for name in REQUIRED_SELECTORS:
            if not self.selectors.get(name):
                raise ConfigError(f"{who} has no {name} selector")
        for name, selector in self.selectors.items():
            if name not in SELECTORS:
                raise ConfigError(f"{who} has an unknown selector {name!r}")
            if selector:
                try:
                    compile_selector(selector)
                except ValueError as problem:
                    raise ConfigError(f"{who}: {problem}") from None
        try:
            translate_layout(self.date_format, self.default_year)
        except ValueError as problem:
            raise ConfigError(f"{who}: {problem}") from None
        if not isinstance(self.max_visits, int) or self.max_visits < 0:
            raise ConfigError(f"{who}: max_visits must be a whole number, 0 for unlimited")
        for pattern in (self.restrict, self.exclude):
            if pattern:
                check_pattern(pattern, who)

    def row(self) -> tuple:
        layout = translate_layout(self.date_format, self.default_year)
        return (
            self.website,
            self.start_point,
            tuple(self.selectors.get(s) or None for s in SELECTORS),
            layout.pattern,
            layout.rewrite,
            self.max_visits,
            self.ignore_all,
            list(self.listed_keys),
            spark_pattern(self.restrict),
            spark_pattern(self.exclude),
        )


@dataclass(frozen=True)
class FeedSettings:
    kind: str
    n: int

    def __post_init__(self):
        if self.kind not in FEED_TYPES:
            raise ConfigError(f"feeds can be of type {' or '.join(FEED_TYPES)}, not {self.kind!r}")
        if not isinstance(self.n, int) or self.n < 1:
            raise ConfigError("nb_items must be 1 or more")


@dataclass(frozen=True)
class Settings:
    sites: tuple[Site, ...]
    driver: str
    connection_data: str
    feeds: FeedSettings | None = None


def check_pattern(pattern: str, who: str) -> None:
    """No look-around, back-references or possessive parts: what regular languages need.

    Whether the pattern is well formed is for the engine to say that runs it; see
    ``sites_table``.
    """
    bare = re.sub(r"\\[^1-9k]", "", pattern)
    if re.search(r"\(\?(?:[=!>]|<[=!])|\\[1-9k]|[*+?}]\+", bare):
        raise ConfigError(f"{who}: unsupported construct in filter {pattern!r}")


def spark_pattern(pattern: str | None) -> str | None:
    """The pattern as Spark spells it: a named group is ``(?<name>...)``. Empty is none."""
    return re.sub(r"((?:^|[^\\])(?:\\\\)*)\(\?P<", r"\1(?<", pattern) if pattern else None


def _site(entry: dict) -> Site:
    who = entry.get("identifier")
    if "query" in entry and "ignore" in entry:
        raise ConfigError(f"site {who!r}: give either 'query' or 'ignore', not both")
    query = entry.get("query", entry.get("ignore"))
    listed = (query or {}).get("except") or []
    if not isinstance(listed, list):
        raise ConfigError(f"site {who!r}: 'except' must be a list, got {listed!r}")
    filters = entry.get("filters") or {}
    return Site(
        website=who,
        start_point=entry.get("start_point"),
        selectors=dict(entry.get("selectors") or {}),
        date_format=entry.get("date_format") or "",
        max_visits=entry.get("max_visits") or 0,
        ignore_all=None if query is None else bool(query.get("ignore_all", False)),
        listed_keys=tuple(str(k) for k in listed),
        restrict=filters.get("restrict"),
        exclude=filters.get("exclude"),
        default_year=entry.get("default_year"),
    )


def parse_settings(text: str) -> Settings:
    try:
        import yaml
    except ImportError as missing:
        raise ConfigError("reading YAML configuration needs the yaml package") from missing
    try:
        raw = yaml.safe_load(text) or {}
    except yaml.YAMLError as problem:
        raise ConfigError(f"the settings are no YAML: {problem}") from None
    if not isinstance(raw, dict):
        raise ConfigError("the settings must be a mapping of sections")
    sites = tuple(_site(entry) for entry in raw.get("websites") or [])
    check_unique(sites)
    database = raw.get("database") or {}
    driver = database.get("driver", "parquet")
    if driver not in STORE_DRIVERS:
        raise ConfigError(f"articles can be kept in {' or '.join(STORE_DRIVERS)}, not in {driver!r}")
    feeds = raw.get("feeds")
    return Settings(
        sites=sites,
        driver=driver,
        connection_data=database.get("connection_data", ""),
        feeds=None if feeds is None else FeedSettings(feeds.get("type"), feeds.get("nb_items", 0)),
    )


def settings_error(text: Column) -> Column:
    """What is wrong with a settings text, null if nothing: the loader's own rules, for texts kept in a table."""

    @F.arrow_udf("string")
    def judged(texts: pa.Array) -> pa.Array:
        found = []
        for one in texts.to_pylist():
            try:
                parse_settings(one or "")
                found.append(None)
            except ConfigError as problem:
                found.append(str(problem))
            except (AttributeError, TypeError, ValueError) as problem:
                found.append(f"a section has another form than expected: {problem}")
        return pa.array(found, pa.string())

    return judged(text)


def load_settings(path: str) -> Settings:
    with open(path, encoding="utf-8") as handle:
        return parse_settings(handle.read())


def check_unique(sites) -> None:
    names = [s.website for s in sites]
    twice = sorted({n for n in names if names.count(n) > 1}) if len(names) != len(set(names)) else []
    if twice:
        raise ConfigError(f"identifiers used more than once: {twice}")


def check_patterns(spark: SparkSession, sites) -> None:
    """Run every filter once, so that one that Spark refuses is named before any job starts."""
    patterns = {spark_pattern(p): s.website for s in sites for p in (s.restrict, s.exclude) if p}

    def run(some: list[str]) -> None:
        rows = spark.createDataFrame([(p,) for p in some], "p string")
        rows.select(F.regexp_instr(F.lit("x"), F.col("p"))).collect()

    def bad(some: list[str]) -> str | None:
        try:
            run(some)
        except Exception:
            half = len(some) // 2
            return some[0] if len(some) == 1 else bad(some[:half]) or bad(some[half:])
        return None

    if patterns and (wrong := bad(list(patterns))) is not None:
        raise ConfigError(f"site {patterns[wrong]!r}: Spark can't compile the filter {wrong!r}")


def sites_table(spark: SparkSession, sites) -> DataFrame:
    """One row per site; marked for broadcast up to ``BROADCAST_BYTES`` of rules, else left to the planner."""
    sites = list(sites)
    check_unique(sites)
    check_patterns(spark, sites)
    rows = [s.row() for s in sites]
    table = spark.createDataFrame(rows, SITES_DDL)
    return F.broadcast(table) if sum(len(repr(r).encode()) for r in rows) <= BROADCAST_BYTES else table
