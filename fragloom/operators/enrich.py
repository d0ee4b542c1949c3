"""Observations with what external sets report on their URLs: nearest in time, first in order, agreement of codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fragloom.functions.urls import Suffixes

#: Fixed value: reports count within an hour of the observation.
WITHIN = 3600


def time_distance(a: Column, b: Column) -> Column:
    """Seconds between two times; infinite if either is unknown."""
    return F.coalesce(F.abs(F.unix_micros(a.cast("timestamp")) - F.unix_micros(b.cast("timestamp"))) / 1e6, F.lit(float("inf")))


def first_by(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the order, by one aggregate with partial results."""
    rest = [c for c in rows.columns if c not in key]
    best = rows.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(*key, "_r.*")


#: A time cell of an as-of join is so many times as wide as its reach; rows of the right side near its ends are in two cells.
CELL = 4
#: Rows of the left side beyond which a cell of one key is dealt to several tasks.
CELL_ROWS = 200_000


def nearest(left: DataFrame, right: DataFrame, key: list[str], left_time: str, right_time: str, order: list[str], within: float | None = WITHIN, prefix: str = "near_") -> DataFrame:
    """left with the nearest row of right by key (its columns prefixed), the distance, and how many rows lie within.

    Rows without any keep nulls and a count of 0, as do rows of left without
    key or time. Ties go by the order of right's columns. Rows of left may repeat.

    Both sides are sorted once by key and time: the last row of right before
    and the first one after are carried along, and the count rises and falls
    where a row of right comes into reach and leaves it, so the work is
    proportional to the rows, however many of them share a key. With `within`,
    keys are cut into time cells, and cells with very many rows of left are
    dealt out, with the cell's rows of right repeated.
    """
    names, own, cell_key = [c for c in right.columns if c not in key], left.columns, [*key, "_cell", "_salt"]
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    reach = None if within is None else int(within * 1_000_000)
    known = F.lit(True)
    for c in key:
        known &= F.col(c).isNotNull()
    # rows of right of one key and time are one: the first of them answers for all
    r = right.select(*key, micros(right_time).alias("_t"), F.struct(*names).alias("_r")).where(known & F.col("_t").isNotNull())
    r = r.groupBy(*key, "_t").agg(F.min_by("_r", F.struct(*[F.col(f"_r.{o}") for o in order])).alias("_r"), F.count("*").alias("_n"))
    at = left.select(*key, micros(left_time).alias("_t"), F.struct(*own).alias("_l"))
    lost = at.where(~known | F.col("_t").isNull()).select("_l", F.lit(None).cast(r.schema["_r"].dataType).alias("_r"), F.lit(None).cast("double").alias("distance"), F.lit(0).cast("long").alias("candidates"))
    at = at.where(known & F.col("_t").isNotNull())
    if reach is None:
        at, r = (x.withColumns({"_cell": F.lit(0).cast("long"), "_salt": F.lit(0).cast("long")}) for x in (at, r))
    else:
        width = max(1, CELL * reach)
        cell = lambda t: F.floor(t / F.lit(width))
        at = at.withColumn("_cell", cell(F.col("_t")))
        r = r.withColumn("_cell", F.explode(F.sequence(cell(F.col("_t") - reach), cell(F.col("_t") + reach))))
        heavy = at.groupBy(*key, "_cell").agg(F.floor(F.count("*") / CELL_ROWS).alias("_parts")).where("_parts > 0")
        parts = F.coalesce("_parts", F.lit(0).cast("long"))
        plain = [F.col(f"_l.{c}") for c, kind in left.dtypes if "map<" not in kind and "variant" not in kind]
        at = at.join(heavy, [*key, "_cell"], "left").withColumn("_salt", F.pmod(F.xxhash64(*plain), parts + 1)).drop("_parts")
        r = r.join(heavy, [*key, "_cell"], "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), parts))).drop("_parts")
    none = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    asked = at.select(*cell_key, "_t", F.lit(1).alias("_rank"), "_l", none(r, "_r"), F.lit(0).cast("long").alias("_n"))
    given = lambda t, rank, value, n: r.select(*cell_key, t.alias("_t"), F.lit(rank).alias("_rank"), none(at, "_l"), value, n.cast("long").alias("_n"))
    t = F.col("_t")
    if reach is None:
        events = asked.unionByName(given(t, 0, F.col("_r"), F.col("_n")))
    else:
        nothing = none(r, "_r")
        events = asked.unionByName(given(t, 0, F.col("_r"), F.lit(0))).unionByName(given(t - reach, 0, nothing, F.col("_n"))).unionByName(given(t + reach, 2, nothing, -F.col("_n")))
    value = F.when(F.col("_r").isNotNull(), F.struct("_t", "_r"))
    up = Window.partitionBy(*cell_key).orderBy("_t", "_rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy(*cell_key).orderBy(F.desc("_t"), "_rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    count = F.sum("_n").over(up) if reach is not None else F.sum("_n").over(Window.partitionBy(*cell_key))
    met = events.select("_l", "_t", count.alias("candidates"), F.last(value, ignorenulls=True).over(up).alias("_before"), F.last(value, ignorenulls=True).over(down).alias("_after")).where("_l is not null")
    choice = lambda v: F.when(F.col(v).isNotNull(), F.struct(F.abs(F.col("_t") - F.col(f"{v}._t")).alias("d"), F.struct(*[F.col(f"{v}._r.{o}").alias(f"o{i}") for i, o in enumerate(order)]).alias("o"), F.col(f"{v}._r").alias("r")))
    near = lambda v: choice(v) if reach is None else F.when(F.abs(F.col("_t") - F.col(f"{v}._t")) <= reach, choice(v))
    later = F.col("_b").isNull() | (F.col("_a").isNotNull() & (F.struct("_a.d", "_a.o") < F.struct("_b.d", "_b.o")))
    first = F.when(later, F.col("_a")).otherwise(F.col("_b"))
    met = met.select("_l", "candidates", near("_before").alias("_b"), near("_after").alias("_a")).withColumn("_best", first)
    out = met.select("_l", F.col("_best.r").alias("_r"), (F.col("_best.d") / 1e6).alias("distance"), "candidates").unionByName(lost)
    return out.select(*[F.col(f"_l.{c}").alias(c) for c in own], *[F.col(f"_r.{n}").alias(prefix + n) for n in names], "distance", "candidates")


def restricted(rows: DataFrame, targets: DataFrame, key: list[str]) -> DataFrame:
    """Only the rows whose key an observation has, before anything of them is parsed."""
    return rows.join(targets.select(*key).distinct(), key, "left_semi")


def code_sets(rows: DataFrame, key: str, code: str) -> DataFrame:
    """key, codes: the sorted set of two-letter codes reported for it."""
    valid = rows.where(F.col(code).rlike("^[A-Z]{2}$"))
    return valid.groupBy(key).agg(F.sort_array(F.collect_set(code)).alias("codes"))


def most_specific(hosts: DataFrame, lookup: DataFrame, suffixes: Suffixes) -> DataFrame:
    """host, matched, codes: of the host and its parents down to the registrable domain, the first that the lookup (domain, codes) has."""
    steps = hosts.select("host").distinct().select("host", F.posexplode(suffixes.candidates_column(F.col("host"))).alias("_at", "domain"))
    found = steps.join(lookup.select("domain", "codes"), "domain")
    best = found.groupBy("host").agg(F.min_by(F.struct("domain", "codes"), "_at").alias("_b"))
    return best.select("host", F.col("_b.domain").alias("matched"), F.col("_b.codes").alias("codes"))


def choose_country(host: Column, url_codes: Column, host_codes: Column, matched: Column, listed: Column, iso: Column, names: Column) -> Column:
    """The publisher's country: codes of the URL, else of the host on that day, else of the historical list.

    Several codes of the same standing conflict and decide nothing; a list that
    disagrees with a single code is reported beside it. Codes without an ISO
    counterpart are marked as such.
    """
    full = lambda c: F.size(F.coalesce(c, F.array().cast("array<string>"))) > 0
    level = F.when(full(url_codes), 1).when(full(host_codes), 2).when(full(listed), 3).otherwise(0)
    codes = F.when(level == 1, url_codes).when(level == 2, host_codes).when(level == 3, listed)
    one = F.size(codes) == 1
    fips = F.when(one, F.element_at(codes, 1))
    history = F.when(matched == host, "historical_lookup_exact").otherwise("historical_lookup_parent")
    method = F.when(level == 1, "exact_url").when(level == 2, "exact_host_same_day").when((level == 3) & one, history).when(level == 3, "historical_lookup")
    status = F.when(level == 0, "unknown").when(~one, "conflicting").when(F.element_at(iso, fips).isNotNull(), "estimated").otherwise("unmapped_fips")
    disagrees = level.isin(1, 2) & one & full(listed) & ~F.array_contains(listed, fips)
    return F.struct(
        F.element_at(iso, fips).alias("iso2"), status.alias("status"), method.alias("method"), fips.alias("fips"), F.element_at(names, fips).alias("name"),
        F.when((level > 0) & ~one, codes).alias("candidates"), F.when(level.isin(1, 2) & one, host).when((level == 3) & one, matched).alias("matched_domain"),
        F.when(disagrees, listed).alias("historical_disagreement"),
    )


def coalesced(pairs: dict[str, list[tuple[str, Column]]]) -> list[Column]:
    """For each field, the first source that has it, and which one that is: name and name_source."""
    out = []
    for name, sources in pairs.items():
        filled = [(s, F.nullif(c, F.lit(""))) for s, c in sources]
        out.append(F.coalesce(*[c for _, c in filled]).alias(name))
        out.append(F.coalesce(*[F.when(c.isNotNull(), F.lit(s)) for s, c in filled]).alias(f"{name}_source"))
    return out


def enrich(observations: DataFrame, *, pages: DataFrame, tags: DataFrame, graph: DataFrame, places: DataFrame, lookup: DataFrame, suffixes: Suffixes, iso: Column, names: Column) -> DataFrame:
    """observations (row_id, url, host, observed_at as a time, ...) with a struct `metadata`.

    pages: url, line_no, title, description, outlet, author, page_date; first wins.
    tags: url, line_no, seen_at, title, description, outlet, author, published; nearest wins.
    graph: url, source, record_id, seen_at, themes, persons, organizations, mentioned, tone_value, word_count; nearest wins.
    places: url, host, seen_at, domain_code, place_code. lookup: domain, codes.
    Nothing of an observation is changed, and none is lost or repeated.
    """
    page = first_by(restricted(pages, observations, ["url"]), ["url"], ["line_no"])
    by_tag = nearest(observations.select("row_id", "url", "observed_at"), restricted(tags, observations, ["url"]), ["url"], "observed_at", "seen_at", ["line_no"], prefix="tag_")
    by_graph = nearest(observations.select("row_id", "url", "observed_at"), restricted(graph, observations, ["url"]), ["url"], "observed_at", "seen_at", ["source", "record_id"], prefix="graph_")
    reported = observations.select("row_id", "url", "observed_at").join(places.select("url", "seen_at", "domain_code", "place_code"), "url")
    reported = reported.where(time_distance(F.col("observed_at"), F.col("seen_at")) <= WITHIN)
    code = lambda c: F.sort_array(F.collect_set(F.when(F.col(c).rlike("^[A-Z]{2}$"), F.col(c))))
    own = reported.groupBy("row_id").agg(code("domain_code").alias("_url_codes"), code("place_code").alias("_places"))
    hosts = code_sets(places.select("host", "domain_code"), "host", "domain_code").withColumnRenamed("codes", "_host_codes")
    listed = most_specific(observations, lookup, suffixes).withColumnRenamed("codes", "_listed")
    all_ = (
        observations.join(page.select("url", F.struct("title", "description", "outlet", "author", "page_date").alias("_page")), "url", "left")
        .join(by_tag.select("row_id", F.struct(*[c for c in by_tag.columns if c.startswith("tag_")]).alias("_tag")), "row_id")
        .join(by_graph.select("row_id", "candidates", F.when(F.col("candidates") > 0, F.struct(*[F.col(c).alias(c[6:]) for c in by_graph.columns if c.startswith("graph_")])).alias("_graph")), "row_id")
        .join(own, "row_id", "left").join(hosts, "host", "left").join(listed, "host", "left")
    )
    fields = {t: [("pages", F.col(f"_page.{f}")), ("tags", F.col(f"_tag.tag_{f}"))] for f, t in (("title", "title"), ("description", "description"), ("outlet", "publisher"), ("author", "author"))}
    country = choose_country(F.col("host"), F.col("_url_codes"), F.col("_host_codes"), F.col("matched"), F.col("_listed"), iso, names)
    metadata = F.struct(
        F.col("host").alias("source_domain"), *coalesced(fields), F.col("_page.page_date").alias("page_date"), F.col("_tag.tag_published").alias("published_at_reported"),
        country.alias("source_country"), F.col("_graph").alias("graph"), F.col("candidates").alias("graph_candidates"), F.coalesce("_places", F.array().cast("array<string>")).alias("places"),
    )
    return all_.select(*[F.col(c) for c in observations.columns], metadata.alias("metadata"))


def coverage(enriched: DataFrame) -> DataFrame:
    """kind, value, n: how many observations have each field, and by which method and status their country was found."""
    m = "metadata."
    fields = [F.when(F.col(m + f).isNotNull(), F.struct(F.lit("field").alias("kind"), F.lit(f).alias("value"))) for f in ("title", "description", "publisher", "author", "graph", "published_at_reported")]
    country = [F.struct(F.lit(k).alias("kind"), F.coalesce(F.col(f"{m}source_country.{k}"), F.lit("unknown")).alias("value")) for k in ("status", "method")]
    return enriched.select(F.explode(F.array_compact(F.array(*fields, *country))).alias("_c")).select("_c.*").groupBy("kind", "value").agg(F.count("*").alias("n"))


def running(rows: DataFrame, key: list[str], order: list[str], value: str) -> DataFrame:
    """rows with the running sum of a value within a key."""
    return rows.withColumn("running", F.sum(value).over(Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
