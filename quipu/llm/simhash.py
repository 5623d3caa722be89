"""SimHash near-duplicates through covering locality-sensitive hashing.

Fingerprint: words of the text with A-Z lower-cased, 3-word shingles with
repeats, XXH64 (seed 42) of each; a bit is set where over half of the hashes
set it.

Search: for radius r the 64 bit positions get vectors of r+1 bits, and every
non-zero vector v of r+1 bits gives a mask: the positions whose vector has an
odd overlap with v.  The vectors of the at most r positions in which two near
fingerprints differ span at most r dimensions, so some v is orthogonal to all
of them, and under that v's mask the two agree.  2^(r+1)-1 tables find every pair, with
certainty.

A table's bucket is never expanded into pairs of rows.  Buckets are dealt to
tasks, and inside one only a spanning forest of its links is given out.  A
bucket over ``block`` fingerprints is covered a second time: its members agree
under its mask, so masks over the other positions part it into buckets that
agree in about 50 bits, again with every link in some of them.  What is crowded
even then is parted into blocks, and each pair of blocks is its own group, so a
hot bucket spreads over many tasks without losing a link.  Only distinct
fingerprints take part: thousands of equal texts are one of them.

Defined results
    null or empty text: no words, fingerprint 0, linked like any other.  A very
    long text is judged whole; a worker holds its words and one hash each.
    Repeated rows share their component.  A null key never becomes a component
    id unless its component has no other.  Extra columns, whatever their names,
    are ignored by :func:`near_duplicates` and kept by :func:`keep_first`.  An
    empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import Scratch, cache_of, fresh, materialize, prepare
from .components import connected_components

RADIUS = 3
BLOCK = 1024


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(words, words[1:], words[2:])) if len(words) >= 3 else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, 42) for s in shingles], "<u8")
    over = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column) -> Column:
    """Fingerprints as signed 64-bit integers."""

    @F.pandas_udf("long")
    def fingerprint_of(texts: pd.Series) -> pd.Series:
        cache_of("none")
        return pd.Series(np.array([fingerprint(t) for t in texts], "u8").view("i8"))

    return fingerprint_of(text)


def covering_masks(radius: int = RADIUS, agreed: int = 0) -> list[int]:
    """One mask per non-zero vector v of radius+1 bits: the positions whose vector overlaps v an odd number of times, and ``agreed``.

    Positions outside ``agreed`` take the non-zero vectors in turn.  Two
    fingerprints that agree in ``agreed`` collide under v when no differing
    position is in v's mask; at most ``radius`` differing positions leave some v
    orthogonal to all of their vectors.
    """
    top = (1 << (radius + 1)) - 1
    open_bits = [i for i in range(64) if not agreed >> i & 1]
    vectors = {i: 1 + (k * 7) % top for k, i in enumerate(open_bits)}
    return [agreed | sum(1 << i for i, a in vectors.items() if (a & v).bit_count() % 2) for v in range(1, top + 1)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (node, root) that join the same fingerprints as all pairs within ``radius`` do."""
    values = np.unique(prints)
    raw, left, out = values.view("u8"), np.ones(len(values), bool), []
    for k in range(len(values)):
        if not left[k]:
            continue
        left[k] = False
        wave = [k]
        while wave:
            rest = np.flatnonzero(left)
            if not len(rest):
                break
            near = np.zeros(len(rest), bool)
            for i in range(0, len(wave), 256):
                near |= (np.bitwise_count(raw[rest][:, None] ^ raw[wave[i : i + 256]][None, :]) <= radius).any(axis=1)
            wave = rest[near].tolist()
            left[wave] = False
            out += [(int(values[w]), int(values[k])) for w in wave]
    return out


def _bucket_links(radius: int):
    """Arrow-batch map over rows sorted by bucket: links within each bucket."""

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry = None
        columns = ["mask_no", "key", "b1", "b2"]

        def emit(pdf: pd.DataFrame) -> pd.DataFrame:
            keys = pdf[columns].to_numpy()
            prints = pdf["fp"].to_numpy()
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            sizes = np.diff(np.r_[starts, len(keys)])
            two = starts[sizes == 2]
            a, b = prints[two], prints[two + 1] if len(two) else prints[two]
            close = np.bitwise_count(a.view("u8") ^ b.view("u8")) <= radius
            found = list(zip(a[close].tolist(), b[close].tolist()))
            for at, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                found += forest(prints[at : at + n], radius)
            return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

        for pdf in batches:
            if carry is not None:
                pdf = pd.concat([carry, pdf], ignore_index=True)
            if not len(pdf):
                continue
            whole = pdf[columns].to_numpy()
            last = np.flatnonzero((whole != whole[-1]).any(axis=1))
            cut = int(last[-1]) + 1 if len(last) else 0
            carry = pdf.iloc[cut:].reset_index(drop=True)
            if cut:
                yield emit(pdf.iloc[:cut])
        if carry is not None and len(carry):
            yield emit(carry)

    return links


def _crowded(rows: DataFrame, block: int, scratch: Scratch, name: str) -> DataFrame:
    """Buckets of over ``block`` rows and how many blocks they fill; counted map-side first."""
    sizes = rows.groupBy("mask_no", "key").agg(F.count("*").alias("n")).filter(F.col("n") > block)
    return scratch.put(sizes.select("mask_no", "key", F.ceil(F.col("n") / block).cast("int").alias("blocks")), name)


def link_fingerprints(distinct: DataFrame, scratch: Scratch, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect exactly what all pairs of ``distinct(fp)`` within ``radius`` bits connect."""
    masks = covering_masks(radius)

    def tables(numbered) -> Column:
        return F.explode(F.array(*[F.struct(F.lit(k).alias("mask_no"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for k, m in numbered]))

    rows = distinct.select("fp", tables(enumerate(masks)).alias("t")).select("fp", "t.mask_no", "t.key")
    hot = _crowded(rows, block, scratch, "hot_buckets")
    one = F.lit(0)
    plain = rows.join(hot, ["mask_no", "key"], "left_anti").select("mask_no", "key", one.alias("b1"), one.alias("b2"), "fp")
    if not hot.isEmpty():
        crowd = rows.join(hot, ["mask_no", "key"], "left_semi")
        within = None
        for k, m in enumerate(masks):
            numbered = [(len(masks) * (k + 1) + j, x) for j, x in enumerate(covering_masks(radius, m))]
            part = crowd.filter(F.col("mask_no") == k).select("fp", tables(numbered).alias("t"))
            within = part if within is None else within.unionByName(part)
        finer = within.select("fp", "t.mask_no", "t.key")
        parts = F.coalesce(F.col("blocks"), F.lit(1))
        dealt = (
            finer.join(_crowded(finer, block, scratch, "hot_within"), ["mask_no", "key"], "left")
            .withColumn("own", F.pmod(F.xxhash64("fp"), parts).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
            .select("mask_no", "key", F.least("own", "other").alias("b1"), F.greatest("own", "other").alias("b2"), "fp")
        )
        plain = plain.unionByName(dealt)
    group = ["mask_no", "key", "b1", "b2"]
    return plain.repartition(*group).sortWithinPartitions(*group).mapInPandas(_bucket_links(radius), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, radius: int = RADIUS, block: int = BLOCK, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the least doc_id reachable through links)."""
    prepare(docs.sparkSession)
    prints = materialize(docs.select(F.col(f"`{key}`").alias("doc_id"), fingerprint_column(F.col(f"`{text}`")).alias("fp")), "fingerprints")
    return components_of(prints, radius, block).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def roots_of(classes: DataFrame, first: str, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``classes(fp, first)`` with root, a fingerprint that tells components apart, and least, the least ``first`` of the component."""
    with Scratch(classes.sparkSession) as scratch:
        roots = connected_components(link_fingerprints(classes.select("fp"), scratch, radius, block))
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", first, F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min(first).alias("least"))
    return materialize(named.join(least, "root"), "class_components")


def components_of(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``prints(doc_id, fp, ...)`` with component_id."""
    classes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    of = roots_of(classes, "first_id", radius, block).select(F.col("fp").alias("class_fp"), F.col("least").alias("component_id"))
    return prints.join(of, prints["fp"] == of["class_fp"]).drop("class_fp")


def keep_first(docs: DataFrame, radius: int = RADIUS, block: int = BLOCK, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each component: the one of the least key (rows without a key last), then of the least text hash.

    A text is known by its key and 128 bits of hash, so that keys with several
    texts, or none, lose no text that has no copy.  The search moves keys,
    hashes and fingerprints only; the texts are moved at most once, by the
    anti-join.  Of repeated rows one stays, by the hash of its whole row.
    """
    prepare(docs.sparkSession)
    k, t = F.col(f"`{key}`"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    h1, h2 = F.xxhash64(t), F.xxhash64(F.lit(1), t)
    rows = docs.select(k.alias("k"), h1.alias("h1"), h2.alias("h2"), fingerprint_column(F.col(f"`{text}`")).alias("fp"))
    texts = materialize(rows.groupBy("k", "h1", "h2").agg(F.min("fp").alias("fp"), F.count("*").alias("n")), "texts")
    own = F.struct(F.col("k").isNull().alias("keyless"), "k", "h1", "h2")
    classes = materialize(texts.groupBy("fp").agg(F.min(own).alias("first")), "classes")
    judged = texts.join(roots_of(classes, "first", radius, block).select("fp", "least"), "fp").withColumn("stays", own == F.col("least"))
    judged = judged.filter(~F.col("stays") | (F.col("n") > 1)).select("k", "h1", "h2", "stays")
    names = {c: fresh(docs, f"near_{c}") for c in ("k", "h1", "h2")}
    judged = materialize(judged.select(*[F.col(c).alias(n) for c, n in names.items()], "stays"), "judged")
    same = k.eqNullSafe(F.col(names["k"])) & (h1 == F.col(names["h1"])) & (h2 == F.col(names["h2"]))
    # The texts stream past a hash table of keys, unsorted; a partition's share of the keys is a small part of its texts.
    kept = docs.join(judged.drop("stays").hint("shuffle_hash"), same, "left_anti")
    repeated = judged.filter("stays").drop("stays")
    if repeated.isEmpty():
        return kept
    hashed = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind]
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    once = docs.join(repeated, same, "left_semi").groupBy(k, h1, h2).agg(F.min_by(whole, F.xxhash64(*hashed)).alias(names["k"]))
    return kept.unionByName(once.select(f"{names['k']}.*"))
