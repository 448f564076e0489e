"""Nearest stems of an item bank by Jaro similarity, with bounds that spare most comparisons.

Two texts of lengths la and lb that have c letters in common (counted with repeats) have a similarity of at most
(c / la + c / lb + 1) / 3.  Letters are counted in ``CLASSES`` classes, which can only raise c.  The bank is packed into blocks of
one domain, by bands of lengths and counts of its rarest classes where a domain is large; a directory of the blocks has each one's
lengths and greatest counts.  A probe is joined with the directory entries of its domain (or those of the whole bank) and meets the blocks whose bound reaches
what it needs: the wanted similarity, or for the k best first the most promising block, then those that can still beat the k-th.
Inside a block the same bound, stem by stem, decides which stems are compared at all.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from respan.functions.text import EditBatch, JaroIndex
from respan.lineage import cut_lineage

CLASSES = 32
BANK_BLOCK = 1_000  # stems of a block, about
PROBE_BLOCK = 256  # probes packed together, about: those of them that meet a block are compared at once
BROADCAST_CHARS = 32_000_000  # bank text up to this size is broadcast
FIRST_LOOK = 64  # stems compared before the bound of the rest is held against the k-th best
_RARE = 3  # classes in the signature of a large band
_SLACK = 1e-9  # for rounding

ANY = "*"  # key of probes that name no domain; a domain's own key is "=" and its name
_FOUND = pa.schema(
    [
        ("domain_key", pa.string()), ("stem_key", pa.string()), ("candidate_QID", pa.string()), ("candidate_domain", pa.string()),
        ("candidate_stem", pa.string()), ("similarity_jw", pa.float64()), ("distance_lv", pa.int32()),
    ]
)
_FOUND_DDL = (
    "domain_key string, stem_key string, candidate_QID string, candidate_domain string, candidate_stem string, "
    "similarity_jw double, distance_lv int"
)


# ---- letters and bounds --------------------------------------------------

def letter_counts(text: str) -> np.ndarray:
    return np.bincount(np.frombuffer(text.encode("utf-32-le"), np.uint32) % CLASSES, minlength=CLASSES)


def with_letters(rows: DataFrame, text: str) -> DataFrame:
    """Adds ``size`` and ``letters`` (counts by class) of a text column; null counts as empty."""
    out = rows.schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            sizes = np.array([len(t) for t in texts], np.int32)
            codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32) % CLASSES
            counts = np.bincount(np.repeat(np.arange(len(texts)), sizes) * CLASSES + codes, minlength=len(texts) * CLASSES)
            ends = pa.array(np.arange(len(texts) + 1) * CLASSES, pa.int32())
            letters = pa.ListArray.from_arrays(ends, pa.array(counts, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes), letters], [*out, "size", "letters"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{ddl}, size int, letters array<int>")


def common_letters(a: Column, b: Column) -> Column:
    """At most so many letters of two texts can match, from their counts."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)


def bound(common: Column, a: Column, b: Column) -> Column:
    """No Jaro similarity of texts of sizes a and b with so many common letters is higher."""
    return F.when(common > 0, (common / a + F.least(common / b, F.lit(1.0)) + 1) / 3).otherwise(F.lit(0.0))


def _bounds(letters: np.ndarray, sizes: np.ndarray, probe: np.ndarray, size: int) -> np.ndarray:
    common = np.minimum(letters, probe).sum(1)
    return np.where(common > 0, (common / size + common / np.maximum(sizes, 1) + 1) / 3, 0.0)


# ---- bank blocks ---------------------------------------------------------

def bank_blocks(bank: DataFrame, block_rows: int | None = None) -> DataFrame:
    """(block, key, items, low, top, high): the different (QID, domain, stem) of the bank, packed by domain and once more as a whole.

    ``key`` is "=" and the domain, or ``ANY`` for the blocks of probes that name none.  What has one key is a domain here: a domain of more than ``block_rows`` rows is cut by bands of lengths, a large band by the counts of the bank's rarest
    classes, and what is still large by a hash.  ``low`` is the least size of a block's stems, ``high`` their greatest count of each class.
    """
    limit = block_rows or BANK_BLOCK
    rows = bank.select("QID", "domain", "stem").distinct().withColumn("text", F.coalesce(F.lower("stem"), F.lit("")))
    rows = cut_lineage(with_letters(rows, "text").drop("text"))
    sums = rows.agg(*[F.sum(F.get("letters", F.lit(i))).alias(f"c{i}") for i in range(CLASSES)]).first()
    present = sorted((int(n), i) for i, n in enumerate(sums) if n)
    rare = [i for _, i in present[:_RARE]]
    band = F.when(F.col("size") > 0, F.floor(4 * F.log2(F.col("size")))).otherwise(-1).cast("int")
    signature = sum((F.least(F.get("letters", F.lit(i)), F.lit(3)) * 4**j for j, i in enumerate(rare)), F.lit(0))
    keys = F.explode(F.array(F.concat(F.lit("="), F.coalesce(F.lower("domain"), F.lit(""))), F.lit(ANY)))
    rows = rows.withColumns({"band": band, "signature": signature, "key": keys})
    # sizes by domain, band and signature: a table of the bank's distinct combinations
    cells = rows.groupBy("key", "band", "signature").agg(F.count("*").alias("n"))
    in_domain, in_band = F.sum("n").over(W.partitionBy("key")), F.sum("n").over(W.partitionBy("key", "band"))
    cells = cells.withColumns({"nd": in_domain, "nb": in_band}).select(
        "key", "band", "signature",
        F.when(F.col("nd") > limit, F.col("band")).alias("use_band"),
        F.when((F.col("nd") > limit) & (F.col("nb") > limit), F.col("signature")).alias("use_signature"),
        F.when((F.col("nd") > limit) & (F.col("nb") > limit), F.ceil(F.col("n") / limit)).otherwise(1).alias("parts"),
    )
    placed = rows.join(cells, ["key", "band", "signature"])
    part = F.pmod(F.xxhash64("QID", "domain", "stem"), F.col("parts"))
    keyed = placed.withColumn("block", F.xxhash64("key", "use_band", "use_signature", part))
    row = F.struct("QID", "domain", "stem")
    high = [F.max(F.get("letters", F.lit(i))).alias(f"h{i}") for i in range(CLASSES)]
    packed = keyed.groupBy("key", "block").agg(F.collect_list(row).alias("items"), F.min("size").alias("low"), F.max("size").alias("top"), *high)
    return packed.select("block", "key", "items", "low", "top", F.array(*[f"h{i}" for i in range(CLASSES)]).alias("high"))


def _keyed(probes: DataFrame) -> DataFrame:
    key = F.when(F.col("domain_key").isNull(), F.lit(ANY)).otherwise(F.concat(F.lit("="), "domain_key"))
    return with_letters(probes.select("domain_key", "stem_key"), "stem_key").withColumn("key", key)


def _met(probes: DataFrame, blocks: DataFrame) -> DataFrame:
    """(domain_key, stem_key, block, ub): each probe with the blocks of its domain, and what similarity they can hold."""
    common = F.least(common_letters(F.col("letters"), F.col("high")), F.col("size"), F.col("top"))
    met = probes.join(blocks.select("key", "block", "low", "top", "high"), "key").withColumn("common", common)
    return met.select("domain_key", "stem_key", "block", bound(F.col("common"), F.col("size"), F.greatest("low", F.lit(1))).alias("ub"))


# ---- inside a block ------------------------------------------------------

class _Block:
    """The stems of a block inside a task; equal (domain, text) pairs are compared once."""

    def __init__(self, items: list[dict], k: int | None):
        grouped: dict[tuple, list] = {}
        for it in items:
            row = (it["QID"], it["domain"], it["stem"])
            grouped.setdefault(((it["domain"] or "").lower(), (it["stem"] or "").lower()), []).append(row)
        self.k = k
        self.texts = [text for _, text in grouped]
        # of equal texts the k least ids are enough
        self.rows = [sorted(rows, key=lambda r: r[0]) if k is None else heapq.nsmallest(k, rows, key=lambda r: r[0]) for rows in grouped.values()]
        self.letters = np.array([letter_counts(t) for t in self.texts]).reshape(-1, CLASSES)
        self.sizes = np.array([len(t) for t in self.texts])
        self.index: JaroIndex | None = None

    def best(self, probes: list[tuple[str, float]]) -> Iterator[tuple]:
        """(probe, QID, domain, stem, similarity, distance) of all that reach a probe's floor and, for the k best, all ties at the border.

        ``probes`` are stems with their floors; a probe is named by its place among them.
        """
        stems, floors = [stem for stem, _ in probes], np.array([floor for _, floor in probes])
        sims = np.full((len(stems), len(self.texts)), -1.0)
        look = max(FIRST_LOOK, self.k or 0)
        first, rest, bounds = [], [], []
        every = np.arange(len(self.texts))
        for stem, floor in probes:
            if floor <= 0 and (self.k is None or len(every) <= 4 * look):  # no bound rules one out
                first.append(every)
                rest.append(every[:0])
                bounds.append(every)
                continue
            ub = _bounds(self.letters, self.sizes, letter_counts(stem), len(stem))
            order = np.argsort(-ub, kind="stable")
            order = order[ub[order] >= max(floor - _SLACK, 0)]
            at = len(order) if self.k is None or len(order) <= 4 * look else look
            first.append(order[:at])
            rest.append(order[at:])
            bounds.append(ub)
        self._compare(stems, first, sims, floors)
        rest = [chosen[ub[chosen] >= floor - _SLACK] for chosen, ub, floor in zip(rest, bounds, floors)]
        self._compare(stems, rest, sims, floors)
        at, text = np.nonzero(sims >= floors[:, None])
        distances = EditBatch().distances([(stems[i], self.texts[j]) for i, j in zip(at, text)])
        for i, j, distance in zip(at.tolist(), text.tolist(), distances):
            for row in self.rows[j]:
                yield (i, *row, float(sims[i, j]), distance)

    def possible(self, stem: str, floor: float) -> int:
        """Items whose bound reaches ``floor``."""
        ub = _bounds(self.letters, self.sizes, letter_counts(stem), len(stem))
        return sum(len(self.rows[i]) for i in np.flatnonzero(ub >= floor - _SLACK))

    def _compare(self, stems: list[str], chosen: list[np.ndarray], sims: np.ndarray, floors: np.ndarray) -> None:
        """Fills in the similarities of every stem to the texts chosen for it, and raises its floor to the k-th best known."""
        dense = []
        for i, some in enumerate(chosen):
            sims[i, some] = 0.0  # an empty text is never similar
            full = some[self.sizes[some] > 0]
            if len(full) and 4 * len(full) < len(self.texts):
                sims[i, full] = JaroIndex([self.texts[j] for j in full]).similarity(stems[i])
            elif len(full):
                dense.append((i, full))
        if dense:
            if self.index is None:
                self.index = JaroIndex([t or " " for t in self.texts])
            for (i, full), row in zip(dense, self.index.similarities([stems[i] for i, _ in dense])):
                sims[i, full] = row[full]
        for i, some in enumerate(chosen):
            known = sims[i][sims[i] >= 0]
            if self.k is not None and len(some) and len(known) >= self.k:
                floors[i] = max(floors[i], np.partition(known, -self.k)[-self.k])


def _search_blocks(k: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                now = batch["block"][row].as_py()
                if now != held:
                    held, block = now, _Block(batch["items"][row].as_py(), k)
                probes = batch["probes"][row].as_py()
                found = block.best([(p["stem_key"], p["floor"]) for p in probes])
                out = [(probes[i]["domain_key"], probes[i]["stem_key"], *hit) for i, *hit in found]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), _FOUND)], schema=_FOUND)

    return run


def _count_possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, block = None, None
    for batch in batches:
        for row in range(batch.num_rows):
            now = batch["block"][row].as_py()
            if now != held:
                held, block = now, _Block(batch["items"][row].as_py(), None)
            probes = batch["probes"][row].as_py()
            n = [block.possible(p["stem_key"], p["floor"]) for p in probes]
            yield pa.RecordBatch.from_pydict({"domain_key": pa.array([p["domain_key"] for p in probes], pa.string()), "stem_key": [p["stem_key"] for p in probes], "n": n})


def _searched(met: DataFrame, blocks: DataFrame, n_probes: int, chars: int, k: int | None) -> DataFrame:
    return _looked_up(met, blocks, n_probes, chars, _search_blocks(k), _FOUND_DDL)


def _looked_up(met: DataFrame, blocks: DataFrame, n_probes: int, chars: int, run, ddl: str) -> DataFrame:
    """Looks the probes (domain_key, stem_key, block, floor) up in their blocks.

    Probes that meet one block are packed into batches.  A small bank (checked by its text) is broadcast; a larger one is spread over
    salts, so that a block which all probes meet does not limit the number of tasks.
    """
    n_batches = max(1, -(-n_probes // PROBE_BLOCK))
    batch = F.pmod(F.xxhash64("domain_key", "stem_key"), F.lit(n_batches))
    packed = met.groupBy("block", batch.alias("batch")).agg(F.collect_list(F.struct("domain_key", "stem_key", "floor")).alias("probes"))
    payload = blocks.select("block", "items")
    if chars <= BROADCAST_CHARS:
        dealt = packed.repartition(min(n_batches, 4096), "block", "batch").sortWithinPartitions("block")  # a task builds a block once
        work = dealt.join(F.broadcast(payload), "block")
    else:
        salts = min(n_batches, 256)
        salted = payload.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        work = packed.withColumn("salt", F.pmod("batch", F.lit(salts)).cast("int")).join(salted, ["block", "salt"])
    return work.select("block", "items", "probes").mapInArrow(run, ddl)


# ---- the searches --------------------------------------------------------

def _prepared(bank: DataFrame) -> tuple[DataFrame, int]:
    size = bank.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("stem")), F.lit(0)).alias("chars")).first()
    return cut_lineage(bank_blocks(bank)), size["chars"] + 64 * size["n"]


def similar_stems(probes: DataFrame, bank: DataFrame, least: float, n_probes: int | None = None, k: int | None = None) -> DataFrame:
    """Bank items with a similarity of ``least`` or more, for each distinct (domain_key, stem_key).

    ``domain_key`` and ``stem_key`` are in lower case; a null domain_key is compared with the whole bank, another with the items of its
    domain.  Probes without a stem and bank rows without a text have none.  With ``k`` only the k best, and ties with the k-th.
    Output ``domain_key, stem_key, candidate_QID, candidate_domain, candidate_stem, similarity_jw, distance_lv``.  Runs jobs.
    """
    blocks, chars = _prepared(bank)
    probes = probes.where("stem_key <> ''").select("domain_key", "stem_key").distinct()
    met = _met(_keyed(probes), blocks).where(F.col("ub") >= least - _SLACK)
    met = met.select("domain_key", "stem_key", "block", F.lit(float(least)).alias("floor"))
    return _searched(met, blocks, n_probes if n_probes is not None else probes.count(), chars, k).where(F.col("similarity_jw") >= least)


def nearest_stems(probes: DataFrame, bank: DataFrame, k: int, n_probes: int | None = None) -> DataFrame:
    """The k best bank items for each distinct (domain_key, stem_key), numbered by ``candidate_rank``.

    Order: similarity (descending), edit distance, QID.  A probe without a stem (null or empty) gets the k least ids of its domain, unscored.
    In the first round a probe meets its most promising block alone; in the second those whose bound reaches its k-th best.
    """
    blocks, chars = _prepared(bank)
    probes = probes.select("domain_key", "stem_key").distinct()
    with_stem, none = probes.where("stem_key <> ''"), probes.where("coalesce(stem_key, '') = ''")
    n = n_probes if n_probes is not None else probes.count()
    met = cut_lineage(_met(_keyed(with_stem), blocks))
    on = ["domain_key", "stem_key"]
    same = lambda a, b: F.col(f"{a}.domain_key").eqNullSafe(F.col(f"{b}.domain_key")) & (F.col(f"{a}.stem_key") == F.col(f"{b}.stem_key"))
    top = met.groupBy(*on).agg(F.max_by("block", F.struct("ub", "block")).alias("block"))
    first = cut_lineage(_searched(top.withColumn("floor", F.lit(0.0)), blocks, n, chars, k))
    kth = first.groupBy(*on).agg(F.sort_array(F.collect_list("similarity_jw"), asc=False).alias("s")).select(*on, F.coalesce(F.get("s", F.lit(k - 1)), F.lit(0.0)).alias("floor"))
    looked = top.alias("t").join(kth.alias("f"), same("t", "f"), "left").select("t.domain_key", "t.stem_key", F.col("t.block").alias("done"), F.coalesce("f.floor", F.lit(0.0)).alias("floor"))
    more = met.alias("m").join(looked.alias("l"), same("m", "l")).where((F.col("m.block") != F.col("l.done")) & (F.col("m.ub") >= F.col("l.floor") - _SLACK))
    second = _searched(more.select("m.domain_key", "m.stem_key", "m.block", "l.floor"), blocks, n, chars, k)
    order = (F.desc_nulls_last("similarity_jw"), F.asc_nulls_last("distance_lv"), F.asc("candidate_QID"))
    ranked = first.unionByName(second).unionByName(_unscored(none, bank, k)).withColumn("candidate_rank", F.row_number().over(W.partitionBy(*on).orderBy(*order)))
    return ranked.where(F.col("candidate_rank") <= k)


def _unscored(none: DataFrame, bank: DataFrame, k: int) -> DataFrame:
    """The k least ids of the domain of every probe without a stem."""
    rows = bank.select("QID", "domain", "stem").distinct()
    keys = rows.select("*", F.explode(F.array(F.concat(F.lit("="), F.coalesce(F.lower("domain"), F.lit(""))), F.lit(ANY))).alias("key"))
    least = keys.withColumn("at", F.row_number().over(W.partitionBy("key").orderBy("QID"))).where(F.col("at") <= k)
    key = F.when(F.col("domain_key").isNull(), F.lit(ANY)).otherwise(F.concat(F.lit("="), "domain_key"))
    return none.withColumn("key", key).join(least, "key").select(
        "domain_key", "stem_key", F.col("QID").alias("candidate_QID"), F.col("domain").alias("candidate_domain"), F.col("stem").alias("candidate_stem"),
        F.lit(None).cast("double").alias("similarity_jw"), F.lit(None).cast("int").alias("distance_lv"),
    )


def stem_bounds(probes: DataFrame, bank: DataFrame, least: float, n_probes: int | None = None) -> DataFrame:
    """``domain_key, stem_key, n_domain, n_possible``: bank items of a probe's domain, and those whose letters and length allow ``least``.

    ``n_possible`` is what ``similar_stems`` compares; the rest is ruled out by counting letters.  Runs jobs.
    """
    blocks, chars = _prepared(bank)
    probes = probes.where("stem_key <> ''").select("domain_key", "stem_key").distinct()
    keyed = _keyed(probes)
    met = _met(keyed, blocks).where(F.col("ub") >= least - _SLACK).select("domain_key", "stem_key", "block", F.lit(float(least)).alias("floor"))
    n = n_probes if n_probes is not None else probes.count()
    counted = _looked_up(met, blocks, n, chars, _count_possible, "domain_key string, stem_key string, n long")
    counted = counted.groupBy("domain_key", "stem_key").agg(F.sum("n").alias("n"))
    sizes = blocks.groupBy("key").agg(F.sum(F.size("items")).alias("n_domain"))
    out = keyed.join(sizes, "key", "left").alias("p").join(counted.alias("c"), F.col("p.domain_key").eqNullSafe(F.col("c.domain_key")) & (F.col("p.stem_key") == F.col("c.stem_key")), "left")
    return out.select("p.domain_key", "p.stem_key", F.coalesce("p.n_domain", F.lit(0)).alias("n_domain"), F.coalesce("c.n", F.lit(0)).alias("n_possible"))
