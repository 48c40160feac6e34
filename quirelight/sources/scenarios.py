"""Compounds of four scenarios put together from whole documents by a seeded plan, so that every seam and how hard it is
are known: binders with a cover and slip sheets, productions under one run of stamps, mixed intake, and single documents
without a seam.

Documents are drawn by their place in a seeded order of their pool; a compound takes the places after those of the one
before, so that a document comes again only when its pool is used up. A pool of fewer documents than a compound takes
gives one of them more than once. Pages without a document or a page number are left out, null texts are empty; of pages
that share a number, the first by text, size and fonts stands. An empty table gives no compounds."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirelight.storage import stored

#: Compounds of a round by scenario, and the most pages that a part of each has.
PLAN = {"exhibit_binder": 10, "bates_production": 12, "mixed_intake": 12, "single_document": 10}
MOST_PAGES = {"exhibit_binder": 12, "bates_production": 14, "mixed_intake": 10, "single_document": 120}
#: Documents that a round of the plan takes on average.
DOCUMENTS_A_ROUND = 140
#: The largest groups of documents of one producer that productions are drawn from, and the least that one has.
PRODUCERS, LEAST_OF_PRODUCER = 5, 3
COVER = "EXHIBITS TO DECLARATION\n\nProduced in response to\nRequest for Production of Documents"
PREFIXES = ("ALDER", "BIRCH", "CEDAR", "DOGWD", "ELMWD")
RANGES = 3  # hex digits of the ranges in which a pool is ordered


def _hash(seed: int, *parts: str | Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]))


def _number(seed: int, *parts: str | Column) -> Column:
    """A whole number below 2**32, the same on every run."""
    return F.conv(F.left(_hash(seed, *parts), F.lit(8)), 16, 10).cast("long")


def profiles(pages: DataFrame) -> DataFrame:
    """source_id, pages, native, families, wide, high: what tells a document's producer, by its first page."""
    first = F.col("page") == 1
    names = F.transform("fonts", lambda f: F.split_part(F.regexp_replace(f, r"^[A-Z]{6}\+", ""), F.lit(","), F.lit(1)))
    families = F.array_join(F.array_sort(F.array_distinct(F.coalesce(names, F.array().cast("array<string>")))), "|")
    tens = lambda c: F.rint(F.max(F.when(first, F.col(c))) / 10).cast("long")
    return pages.groupBy(F.col("document_id").alias("source_id")).agg(
        F.count("*").cast("int").alias("pages"),
        F.coalesce(F.max(F.when(first, F.trim(F.regexp_replace("raw_text", r"\s+", " ")) != "")), F.lit(False)).alias("native"),
        F.coalesce(F.max(F.when(first, families)), F.lit("")).alias("families"),
        tens("width").alias("wide"),
        tens("height").alias("high"),
    )


def pools(profile: DataFrame, long: int) -> DataFrame:
    """source_id, pages, pool: the pools of each document, of which every document has up to four."""
    key = ["families", "wide", "high"]
    kin = profile.where("native and families <> '' and wide is not null and high is not null")
    largest = kin.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_OF_PRODUCER).orderBy(F.desc("n"), *key).limit(PRODUCERS)
    rank = F.row_number().over(Window.orderBy(F.desc("n"), *key))  # of five rows at most
    named = largest.select(*key, F.lit(True).alias("native"), F.concat(F.lit("producer"), rank.cast("string")).alias("producer"))
    of = F.array_compact(F.array(F.lit("any"), F.when(F.col("native"), "native").otherwise("scanned"), F.when(F.col("pages") >= long, "long"), F.col("producer")))
    return profile.join(F.broadcast(named), [*key, "native"], "left").select("source_id", "pages", F.explode(of).alias("pool"))


def placed(rows: DataFrame, seed: int) -> DataFrame:
    """rows of pools and their place from 0 in a seeded order. No task orders a whole pool: rows are ordered within ranges
    of their hash, and what comes before a range is counted."""
    keyed = rows.withColumn("h", _hash(seed, F.col("source_id"))).withColumn("range", F.left("h", F.lit(RANGES)))
    counts = keyed.groupBy("pool", "range").agg(F.count("*").alias("n"))
    before = counts.select("pool", "range", (F.sum("n").over(Window.partitionBy("pool").orderBy("range")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("pool", "range").orderBy("h", "source_id")) - 1
    # a row for each pool and range: 8 * 4,096 at most
    return keyed.withColumn("within", within).join(F.broadcast(before), ["pool", "range"]).select("source_id", "pages", "pool", (F.col("before") + F.col("within")).alias("place"))


def plan(spark, rounds: int, seed: int) -> DataFrame:
    """number, scenario: the compounds, each round's in a seeded order."""
    entries = F.array(*[F.lit(s) for s, n in PLAN.items() for _ in range(n)])
    rows = spark.range(rounds).select(F.col("id").alias("round"), F.posexplode(entries).alias("entry", "scenario"))
    order = Window.partitionBy("round").orderBy(_hash(seed, "plan", F.col("round"), F.col("entry")), "entry")
    return rows.select((F.col("round") * sum(PLAN.values()) + F.row_number().over(order) - 1).alias("number"), "scenario")


def _slots(seed: int, sizes: dict[str, int]) -> Column:
    """The parts that a compound takes, in order: kind, pool, place, rotation."""
    c, has = F.col("number"), lambda pool, other="any": pool if sizes.get(pool) else other
    slot = lambda kind, pool, n, step, i, turn=None: F.struct(F.lit(kind).alias("kind"), F.lit(pool).alias("pool"), F.pmod(c * step + i, n).cast("long").alias("place"), F.lit(turn).cast("int").alias("rotation"))
    size = lambda pool: F.lit(sizes[pool]).cast("long")
    upto = lambda n, of: F.transform(F.sequence(F.lit(0), (n - 1).cast("int")), of)

    binder = upto(3 + F.pmod(_number(seed, "binder", c), F.lit(3)), lambda i: slot("exhibit", "any", size("any"), 5, i))

    want = 3 + F.pmod(_number(seed, "want", c), F.lit(2))
    kin = [sizes[p] for p in (f"producer{k}" for k in range(1, PRODUCERS + 1)) if p in sizes]
    usable = F.when(want == 3, len(kin)).otherwise(sum(n >= 4 for n in kin))
    chosen = F.when(usable > 0, (1 + F.pmod(_number(seed, "producer", c), usable)).cast("int")).otherwise(0)
    pool = F.when(chosen > 0, F.concat(F.lit("producer"), chosen.cast("string"))).otherwise("any")
    of = F.get(F.array(size("any"), *[F.lit(n).cast("long") for n in kin]), chosen)
    production = upto(want, lambda i: slot("production", pool, of, 4, i))

    native = has("native")
    kinds = [("native_filing", native, 0, None), ("landscape_plate", native, 1, 90), ("native_filing", native, 2, None)]
    kinds += [("scanned_exhibit", "scanned", 3, None)] if sizes.get("scanned") else []
    dealt = F.array(*[F.struct(_hash(seed, "mixed", c, str(i)).alias("h"), slot(kind, p, size(p), 1 if p == "scanned" else 3, i % 3, turn).alias("slot")) for kind, p, i, turn in kinds])
    mixed = F.transform(F.array_sort(dealt), lambda x: x["slot"])

    single = F.array(slot("single", has("long"), size(has("long")), 1, 0))
    scenario = F.col("scenario")
    return F.when(scenario == "exhibit_binder", binder).when(scenario == "bates_production", production).when(scenario == "mixed_intake", mixed).otherwise(single)


def distinct_pages(pages: DataFrame) -> DataFrame:
    """Every page once, in the columns that compounds have, numbered from 1 without gaps: of each document the first 120,
    as no part has more. Map sides keep no more of a document, so that a long one meets no task whole."""
    rest = ["raw_text", "width", "height", "fonts", "rotation", "image_count"]
    known = pages.where("document_id is not null and page is not null").select("document_id", "page", F.coalesce("raw_text", F.lit("")).alias("raw_text"), *rest[1:])
    once = known.groupBy("document_id", "page").agg(F.min(F.struct(*rest)).alias("p"))
    number = F.row_number().over(Window.partitionBy("document_id").orderBy("page"))
    first = once.withColumn("number", number).where(F.col("number") <= max(MOST_PAGES.values()))
    return first.select("document_id", F.col("number").alias("page"), *[F.col(f"p.{c}").alias(c) for c in rest])


def parts(pages: DataFrame, seed: int, long: int = 30, rounds: int | None = None) -> DataFrame:
    """A row for each part of a compound: document_id, scenario, slot, kind, source_id, pages, start_page, end_page,
    rotation, stamp_prefix, stamp_first. As many rounds of the plan as take about every document once, unless told."""
    spark = pages.sparkSession
    profile = stored(profiles(pages), "scenario-profiles")
    drawn = stored(placed(pools(profile, long), seed), "scenario-places")
    sizes = {r.pool: r.n for r in drawn.groupBy("pool").agg(F.count("*").alias("n")).collect()}  # nine pools at most
    if rounds is None or not sizes:
        rounds = math.ceil(sizes.get("any", 0) / DOCUMENTS_A_ROUND)
    c = F.col("number")
    slots = plan(spark, rounds, seed).select("number", "scenario", F.posexplode(_slots(seed, {"any": 1} | sizes)).alias("slot", "s")).select("number", "scenario", "slot", "s.*")
    most = F.element_at(F.create_map(*[F.lit(x) for kv in MOST_PAGES.items() for x in kv]), F.col("scenario"))
    rows = slots.join(drawn, ["pool", "place"]).withColumn("pages", F.least("pages", most))
    binder = F.col("scenario") == "exhibit_binder"
    inserted = F.when(binder, F.when(F.col("slot") == 0, 2).otherwise(1)).otherwise(0)
    end = F.sum(F.col("pages") + inserted).over(Window.partitionBy("number").orderBy("slot")).cast("int")
    stamped = F.col("scenario") == "bates_production"
    return rows.withColumn("end_page", end).select(
        F.format_string("compound_%06d_%s", c, "scenario").alias("document_id"), "scenario", "slot",
        F.when(F.col("pool").startswith("producer"), F.concat(F.col("kind"), F.lit("_same_producer"))).otherwise(F.col("kind")).alias("kind"),
        "source_id", "pages", (F.col("end_page") - F.col("pages") + 1).alias("start_page"), "end_page", "rotation",
        F.when(stamped, F.get(F.array(*map(F.lit, PREFIXES)), F.pmod(_number(seed, "prefix", c), F.lit(len(PREFIXES))).cast("int"))).alias("stamp_prefix"),
        F.when(stamped, 1 + F.pmod(_number(seed, "first", c), F.lit(400))).alias("stamp_first"),
    )


def compound_pages(found: DataFrame, pages: DataFrame) -> DataFrame:
    """The compounds' pages, with covers, slip sheets and stamps: document_id, page, raw_text, width, height, rotation,
    image_count, fonts."""
    whole = pages.select(F.col("document_id").alias("p_source"), F.col("page").alias("p_page"), "raw_text", "width", "height", F.col("rotation").alias("p_rotation"), "image_count", "fonts")
    rows = found.join(whole, (F.col("source_id") == F.col("p_source")) & (F.col("p_page") <= F.col("pages")))
    page = F.col("start_page") + F.col("p_page") - 1
    stamp = F.concat("stamp_prefix", F.format_string("%06d", F.col("stamp_first") + page - 1))
    text = F.when(F.col("stamp_prefix").isNull(), F.col("raw_text")).otherwise(F.concat_ws("\n", F.when(F.col("raw_text") != "", F.col("raw_text")), stamp))
    out = rows.select("document_id", page.cast("int").alias("page"), text.alias("raw_text"), "width", "height", F.coalesce("rotation", "p_rotation").alias("rotation"), "image_count", "fonts")
    slip = F.struct((F.col("start_page") - 1).cast("int").alias("page"), F.concat(F.lit("EXHIBIT "), F.char(65 + F.col("slot"))).alias("raw_text"))
    cover = F.when(F.col("slot") == 0, F.struct(F.lit(1).alias("page"), F.lit(COVER).alias("raw_text")))
    made = found.where(F.col("scenario") == "exhibit_binder").select("document_id", F.inline(F.array_compact(F.array(cover, slip))))
    return out.unionByName(made.select("*", F.lit(612.0).alias("width"), F.lit(792.0).alias("height"), F.lit(0).alias("rotation"), F.lit(0).alias("image_count"), F.array(F.lit("Helvetica")).alias("fonts")))


def seams(found: DataFrame) -> DataFrame:
    """document_id, before_page, difficulty, scenario, reason: the compounds' true seams."""
    binder = F.col("scenario") == "exhibit_binder"
    difficulty = F.when(binder, "easy").when(F.col("scenario") == "bates_production", "hard").otherwise("medium")
    same = F.when(F.col("kind").endswith("_same_producer"), "_same_producer").otherwise("")
    reason = F.when(binder, "slip_sheet_announces_boundary").when(F.col("scenario") == "bates_production", F.concat(F.lit("continuous_bates_run"), same)).otherwise(F.concat(F.lit("producer_change_"), "kind"))
    before = F.when(binder, F.col("start_page") - 1).otherwise(F.col("start_page"))
    return found.where(binder | (F.col("slot") > 0)).select("document_id", before.cast("int").alias("before_page"), difficulty.alias("difficulty"), "scenario", reason.alias("reason"))
