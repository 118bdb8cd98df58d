"""Title search (J2, K3): the first catalogue title that *contains* a request.

A request matches a title if its key (lower case, letters and digits only, see
``operators/score.title_key``) occurs anywhere in the title's key, so ``Matrix`` finds
``The Matrix Reloaded``, and whatever the equality lookup finds is found too.  Of several, the
title spelled exactly as requested wins, then the shortest, then the smallest.

An inverted index replaces the comparison of every request with every title:

* ``index_titles`` writes, once per catalogue, the titles, a posting ``(gram, title id)`` for
  each distinct run of one to three characters, and each gram's number of titles.
* A title that contains a request holds all of its grams, so it is enough to look
  at the request's ``RARE`` rarest ones (of three characters, or of the whole request
  if that is shorter).  A gram that no title holds ends the search.  Postings carry the
  key's length (a shorter title cannot match), and a candidate has to appear under each of the
  looked-up grams before its title is fetched and compared.  They also carry a signature of the
  title's runs of three characters, a bit for each: where a posting lacks a bit of the request it goes at once, so
  that what is shuffled is about the hits, not the requests times the titles that share a gram.
* Postings of a frequent gram are dealt to ``salts`` parts by title, about
  ``PART`` each, and a request visits all parts: no task holds a whole list.
* Titles are dealt to tiers by their length, each with about ``TIER`` times the characters of all shorter ones, and searched
  tier by tier.  The shortest title wins, so a request found in one tier is done and is not looked up in the next: one
  that many titles contain only ever meets the few shortest of them, and one that reaches a long tier is rare.
  How often a gram occurs, and in which tiers, is read from ``SLOTS`` sums, so that grams are never shuffled with the requests.
* Spellings of one key are searched once, the best title of a key is a combinable minimum, and the
  exact spelling is an equi-join of its own, so hits are never paired with requests.

Only equi-joins are used; sizes decide in Catalyst what is broadcast, but for the ``SLOTS`` sums.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonality.operators.score import title_key
from tonality.session import shared_dir
from tonality.sources.stages import read_stage, write_stage

GRAM = 3            # characters of a gram; shorter ones serve shorter requests
RARE = 2            # grams of a request that are looked up
PART = 100_000      # postings of a gram that stay together
SIGNATURE = 4       # 64-bit words of a title's signature
TIER = 4            # times the characters of the tiers before
FIRST = 50_000      # characters of the first tier, at least
SLOTS = 1 << 18     # sums that the grams' counts are folded to
POSTING = ("gram string, salt int, id long, size int, signature struct<" + ",".join(f"s{n}:long" for n in range(SIGNATURE)) + ">, tier int")


@dataclass(frozen=True)
class TitleIndex:
    """The written tables of an index: ``titles (id, title, key)``, ``postings (gram, salt, id, size, signature, tier)``,
    ``grams (gram, titles, salts, tiers)``, the grams' sums ``slots (slot, titles, tiers)`` and ``tiers (tier, longest)``.

    ``tiers`` of a gram or slot has a bit for each tier; the last tier has no ``longest`` title."""
    titles: DataFrame
    postings: DataFrame
    grams: DataFrame
    slots: DataFrame
    tiers: DataFrame


def _runs(chars: Column, n: int) -> Column:
    """Distinct runs of ``n`` characters (single look-ups: a slice would copy the whole array each time)."""
    some = F.transform(F.sequence(F.lit(0), F.size(chars) - n), lambda i: F.concat(*[F.get(chars, i + k) for k in range(n)]))
    return F.array_distinct(F.when(F.size(chars) >= n, some).otherwise(F.array().cast("array<string>")))


def _of_characters(key: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the key's characters, which are cut once a row however often the body names them."""
    return F.get(F.transform(F.array(F.regexp_extract_all(key, F.lit("(?s)."), 0)), body), 0)


def all_grams(key: Column) -> Column:
    """What a title is found by: its distinct runs of one to ``GRAM`` characters."""
    return _of_characters(key, lambda c: F.concat(*[_runs(c, n) for n in range(1, GRAM + 1)]))


def asked_grams(key: Column) -> Column:
    """What a request is looked up by: its distinct runs of ``GRAM`` characters, or itself if it is shorter."""
    return F.when(F.length(key) < GRAM, F.array(key)).otherwise(_of_characters(key, lambda c: _runs(c, GRAM)))


def signature(key: Column) -> Column:
    """A bit for each run of ``GRAM`` characters, as a struct of 64-bit words: a key's bits are set in any key that contains it."""
    hashes = F.transform(_of_characters(key, lambda c: _runs(c, GRAM)), lambda g: F.xxhash64(g))
    none = F.struct(*[F.lit(0).cast("long").alias(f"s{n}") for n in range(SIGNATURE)])

    def add(bits: Column, h: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(h, 8), F.lit(64)).cast("int"))
        return F.struct(*[F.when(F.pmod(h, F.lit(SIGNATURE)) == n, bits[f"s{n}"].bitwiseOR(bit)).otherwise(bits[f"s{n}"])
                          .alias(f"s{n}") for n in range(SIGNATURE)])

    return F.aggregate(hashes, none, add)


def _holds(held: str, asked: str) -> Column:
    """Whether a signature has all bits of another."""
    every = F.lit(True)
    for n in range(SIGNATURE):
        bits = F.col(f"{asked}.s{n}")
        every = every & (F.col(f"{held}.s{n}").bitwiseAND(bits) == bits)
    return every


def _tier_bounds(titles: DataFrame) -> list[int]:
    """The longest titles of all tiers but the last."""
    size = F.length("key")
    total = titles.agg(F.sum(size)).first()[0] or 0
    shares = []
    while total >= FIRST * TIER ** (len(shares) + 1):
        shares.append(TIER ** -(len(shares) + 1))
    if not shares:
        return []
    return sorted({int(b) for b in titles.agg(F.percentile(F.length("title"), shares, size)).first()[0]})


def _parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _slot(gram: str) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(SLOTS)).cast("int")


def index_titles(catalogue: DataFrame, path: str | None = None, title_col: str = "title", part: int = PART) -> TitleIndex:
    """Writes the index of a catalogue below ``path`` (by default a new shared folder).

    Null titles and titles without a letter or digit are left out; equal titles are one.
    """
    spark = catalogue.sparkSession
    path = path or shared_dir(spark, "title-index", uuid.uuid4().hex)
    title = F.col(title_col).cast("string")
    titles = (catalogue.select(title.alias("title")).distinct().withColumn("key", title_key("title"))
              .where(F.col("key") != "").select(F.xxhash64("title").alias("id"), "title", "key"))
    write_stage(titles, posixpath.join(path, "titles"))
    titles = read_stage(spark, posixpath.join(path, "titles"))
    bounds = _tier_bounds(titles)
    tiers = spark.createDataFrame(list(enumerate([*bounds, None])), "tier int, longest int")
    write_stage(tiers.coalesce(1), posixpath.join(path, "tiers"))
    tier = sum((F.length("title") > b).cast("int") for b in bounds) if bounds else F.lit(0)
    each = titles.repartition(_parts(spark), "id").select(        # a few MB give many; signature once a title, not once a posting
        "id", F.length("key").alias("size"), tier.alias("tier"), signature(F.col("key")).alias("signature"),
        all_grams(F.col("key")).alias("grams"))
    counted = each.select("tier", F.explode_outer("grams").alias("gram")).groupBy("gram").agg(
        F.count(F.lit(1)).alias("titles"), F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("tier"))).alias("tiers"))
    write_stage(counted.withColumn("salts", F.ceil(F.col("titles") / part).cast("int")), posixpath.join(path, "grams"))
    grams = read_stage(spark, posixpath.join(path, "grams"))
    slots = grams.groupBy(_slot("gram").alias("slot")).agg(F.sum("titles").alias("titles"), F.bit_or("tiers").alias("tiers"))
    write_stage(slots, posixpath.join(path, "slots"))
    salt = F.pmod(F.col("id"), F.coalesce(F.col("salts"), F.lit(1)).cast("long")).cast("int")
    postings = (each.select("id", "size", "tier", "signature", F.explode_outer("grams").alias("gram"))
                .join(_frequent(grams), "gram", "left").select("gram", salt.alias("salt"), "id", "size", "signature", "tier"))
    postings.write.mode("overwrite").partitionBy("tier").parquet(posixpath.join(path, "postings"))
    return open_index(spark, path)


def _frequent(grams: DataFrame) -> DataFrame:
    return grams.where(F.col("salts") > 1).select("gram", "salts")


def open_index(spark: SparkSession, path: str) -> TitleIndex:
    """An index that :func:`index_titles` wrote."""
    titles, grams, slots, tiers = (read_stage(spark, posixpath.join(path, t)) for t in ("titles", "grams", "slots", "tiers"))
    postings = spark.read.schema(POSTING).parquet(posixpath.join(path, "postings"))
    return TitleIndex(titles, postings, grams, slots, tiers)


def _lookups(keys: DataFrame, index: TitleIndex) -> DataFrame:
    """``(key, size, tiers, rare)``: each key's rarest grams and the tiers that hold all its grams; keys without such a tier are gone."""
    dealt = keys.repartition(2 * _parts(keys.sparkSession), "key")     # a few MB give many; as many as before would be left out
    each = dealt.select("key", F.explode_outer(asked_grams(F.col("key"))).alias("gram")).withColumn("slot", _slot("gram"))
    known = each.join(F.broadcast(index.slots), "slot", "left").groupBy("key").agg(      # SLOTS rows at most
        F.bit_and(F.coalesce("tiers", F.lit(0).cast("long"))).alias("tiers"),
        F.sort_array(F.collect_list(F.struct("titles", "gram"))).alias("grams"))
    return known.where(F.col("tiers") != 0).select(
        "key", F.length("key").alias("size"), "tiers", F.slice("grams", 1, RARE)["gram"].alias("rare"))


def held_titles(look: DataFrame, index: TitleIndex) -> DataFrame:
    """The postings under each looked-up gram of titles that can contain the key."""
    return look.join(index.postings, ["gram", "salt"]).where((F.col("size") >= F.col("least")) & _holds("signature", "bits"))


def _tier_hits(look: DataFrame, index: TitleIndex) -> DataFrame:
    """``(key, title)``: the best title of an index for each key looked up that any contains."""
    candidates = held_titles(look, index).groupBy("key", "id").agg(F.count(F.lit(1)).alias("n"), F.first("asked").alias("asked")) \
        .where(F.col("n") >= F.col("asked")).select(F.col("key").alias("wanted"), "id")
    hits = candidates.join(index.titles, "id").where(F.contains("key", "wanted"))
    best = F.min(F.struct(F.length("title").alias("l"), F.col("title").alias("t")))
    return hits.groupBy(F.col("wanted").alias("key")).agg(best.alias("m")).select("key", F.col("m.t").alias("title"))


def first_hits(keys: DataFrame, index: TitleIndex) -> DataFrame:
    """``(key, title)``: of the titles that contain each distinct key, the shortest, then the smallest.

    The hits of each tier are written to the shared folder before the next is searched for the other keys."""
    spark = keys.sparkSession
    path = shared_dir(spark, "title-hits", uuid.uuid4().hex)
    rare = (_lookups(keys, index).withColumn("bits", signature(F.col("key")))
            .select("key", "tiers", F.size("rare").alias("asked"), "bits", F.col("size").alias("least"), F.explode_outer("rare").alias("gram")))
    salted = rare.join(_frequent(index.grams), "gram", "left").withColumn(
        "salt", F.explode_outer(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
    look = read_stage(spark, write_stage(salted, posixpath.join(path, "look")))
    found, above = [], -1
    for tier, longest in sorted(index.tiers.collect()):
        rest = look.where(F.col("tiers").bitwiseAND(F.lit(1 << tier)) != 0)
        if found:
            rest = rest.join(spark.read.parquet(*found).select("key"), "key", "left_anti")
        size = F.length("title")
        part = replace(index, postings=index.postings.where(F.col("tier") == tier).drop("tier"),
                       titles=index.titles.where((size > above) if longest is None else (size > above) & (size <= longest)))
        found.append(write_stage(_tier_hits(rest, part), posixpath.join(path, f"hits-{tier}")))
        above = longest
    return spark.read.parquet(*found)


def search_titles(requests: DataFrame, index: TitleIndex, request_col: str = "request") -> DataFrame:
    """J2 + K3 + P3 by containment: ``(request, title, status)``, one row per distinct request.

    A request that is null, empty or without a letter or digit, or that no title contains, is an
    ``invalid_title``.
    """
    spark = requests.sparkSession
    asked = requests.select(F.col(request_col).alias("request")).distinct().withColumn("key", title_key("request"))
    asked = read_stage(spark, write_stage(asked, shared_dir(spark, "title-requests", uuid.uuid4().hex)))     # read twice
    found = first_hits(asked.where(F.col("key") != "").select("key").distinct(), index)
    exact = index.titles.select(F.col("title").alias("request"), F.col("title").alias("same"))
    title = F.coalesce("same", "title")
    return (asked.join(found, "key", "left").join(exact, "request", "left")
            .select("request", title.alias("title"),
                    F.when(title.isNull(), F.lit("invalid_title")).otherwise(F.lit("ok")).alias("status")))
