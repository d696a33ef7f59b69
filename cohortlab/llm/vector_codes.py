"""Product-quantisation codes of vectors (operator 12), with norm-of-sum bounds.

Components are made whole numbers (``floor(1024 * x)``), a vector is cut into four
parts, and each part position has a codebook of up to 256 entries that four
rounds of assignment and mean improve.  Everything is exact: distances are whole
numbers in doubles below 2^53, or Python integers where the table's components
are too large for that.

**Bounds.**  The entries of a codebook are grouped by nearness at the start.  A
vector's part keeps, for each group, a lower bound of its distance to the group's
entries other than its own, and the round in which that bound was computed (its
stamp).  All codebooks so far are kept: in round t the bound of round T holds less
``max |entry_t - entry_T|`` over the group, the net displacement, which is never
more than the sum of the drifts of the rounds between.  The distance to the own
entry is computed exactly each time; a group is scanned only if its bound does
not exceed it, and then gets a fresh bound and stamp.

**Spark.**  A round is one pass over the state (vector, codes, bounds, stamps),
written to the shared scratch folder, and one aggregate of (part, entry) sums that
each task combines first: 1,024 rows a task.  Codebooks go to the tasks with the
function: at most 5 rounds x 256 entries x dimension numbers, whatever the number of
rows.  A state is removed when the next one is written.

Defined cases: shorter vectors are filled up with zeros to the longest, and the
longest to a multiple of four; fewer than 256 vectors give as many entries;
rows of equal ``vec_id`` are ordered by their components, a null ``vec_id`` comes last;
an empty table gives no rows; sums beyond a long are given as the greatest long;
null and non-finite vectors are dropped; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from cohortlab.llm.common import drop_table
from cohortlab.session import scratch_dir

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Groups of entries with a bound each.
GROUPS = 8
#: Vectors in memory at once.
ROWS = 4096
MAX_LONG = 2 ** 63 - 1


def finite(embedding: str = "embedding") -> Column:
    """Not null, and every component a finite number."""
    e = F.col(embedding)
    return F.coalesce(F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def whole(vector, width: int, exact: bool) -> np.ndarray:
    """``floor(1024 * x)`` of one vector, filled up with zeros."""
    if exact:
        out = np.zeros(width, np.float64)
        out[:len(vector)] = np.floor(np.asarray(vector, np.float64) * SCALE)
        return out
    ratios = [float(x).as_integer_ratio() for x in vector]
    return np.array([SCALE * a // b for a, b in ratios] + [0] * (width - len(vector)), object)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances [row, entry]."""
    return (x * x).sum(axis=1)[:, None] + (entries * entries).sum(axis=1)[None, :] - 2 * (x @ entries.T)


def roots(squares: np.ndarray, up: bool) -> np.ndarray:
    """Square roots in doubles, rounded up, or down to a single-precision number."""
    if squares.dtype == object:
        big = [math.isqrt(int(s)) + up for s in squares.ravel()]
        out = np.array([float(b) if b < 10 ** 300 else (math.inf if up else 1e300) for b in big]).reshape(squares.shape)
    else:
        out = np.sqrt(squares)
    return np.nextafter(out, np.inf) if up else np.nextafter(np.minimum(out, 3e38).astype(np.float32), np.float32(-1))


def grouped(entries: np.ndarray) -> list[np.ndarray]:
    """The entries' numbers in groups: each with the nearest of some evenly spaced entries."""
    seeds = np.unique(np.linspace(0, len(entries) - 1, min(GROUPS, len(entries))).astype(int))
    nearest = distances(entries, entries[seeds]).argmin(axis=1)
    return [np.flatnonzero(nearest == g) for g in range(len(seeds)) if (nearest == g).any()]


@dataclass(frozen=True)
class Codebooks:
    """``history[t][part]``: entries of each round; ``groups[part]``: numbers of entries."""

    history: tuple[tuple[np.ndarray, ...], ...]
    groups: tuple[tuple[np.ndarray, ...], ...]

    @staticmethod
    def start(vectors: np.ndarray) -> Codebooks:
        first = tuple(np.ascontiguousarray(p) for p in np.split(vectors, PARTS, axis=1))
        return Codebooks((first,), tuple(tuple(grouped(p)) for p in first))

    def then(self, entries: list[np.ndarray]) -> Codebooks:
        return Codebooks((*self.history, tuple(entries)), self.groups)

    def moved(self, part: int) -> np.ndarray:
        """[round, group]: the greatest net displacement of a group's entries since that round, rounded up."""
        now = self.history[-1][part]
        return np.array([[roots(((now[g] - then[part][g]) ** 2).sum(axis=1), True).max() * (1 + 1e-9) if then[part] is not now else 0.0
                          for g in self.groups[part]] for then in self.history])

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for p in self.history[-1] for x in p.ravel()).encode()).hexdigest()


def assign(x: np.ndarray, books: Codebooks, part: int, code: np.ndarray, low: np.ndarray, stamp: np.ndarray,
           moved: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """New codes and their squared distances, and the number of distances computed; ``low`` and ``stamp`` [row, group] are renewed in place."""
    entries, groups, now = books.history[-1][part], books.groups[part], len(books.history) - 1
    n, at = len(x), np.arange(len(groups))
    own = ((x - entries[code]) ** 2).sum(axis=1)
    limit = roots(own, True) * (1 + 1e-9)
    bound = low[:, :len(groups)].astype(np.float64) * (1 - 1e-9) - moved[stamp[:, :len(groups)], at]
    scan = ~(bound > limit[:, None])
    best, least, done = code.copy(), own.copy(), n
    held = np.zeros(len(entries), np.int64)  # the group of each entry
    firsts: list[tuple] = []
    for g, members in enumerate(groups):
        held[members] = g
        rows = np.flatnonzero(scan[:, g])
        if not len(rows):
            continue
        d = distances(x[rows], entries[members])
        done += d.size
        line, a = np.arange(len(rows)), d.argmin(axis=1)
        first, number = d[line, a], members[a]
        if len(members) > 1:
            d[line, a] = d.max() + 1
            second = roots(d.min(axis=1), False)
        else:
            second = np.full(len(rows), 3e38, np.float32)
        firsts.append((g, rows, number, first, second))
        better = (first < least[rows]) | ((first == least[rows]) & (number < best[rows]))
        best[rows[better]], least[rows[better]] = number[better], first[better]
    for g, rows, number, first, second in firsts:
        low[rows, g] = np.where(best[rows] == number, second, roots(first, False))
        stamp[rows, g] = now
    # an entry given up is one of the others of its group from now on
    left = np.flatnonzero((best != code) & ~scan[np.arange(n), held[code]])
    low[left, held[code[left]]] = np.minimum(np.maximum(bound[left, held[code[left]]], 0), roots(own[left], False))
    stamp[left, held[code[left]]] = now
    return best, least, done


class _Packing:
    """Vectors, codes, bounds and stamps as fixed-width bytes (or text, for integers beyond 32 bits)."""

    def __init__(self, width: int, exact: bool, limit: float):
        self.width, self.exact = width, exact
        self.kind = None if not exact else np.dtype("<i2") if limit < 2 ** 15 else np.dtype("<i4")

    def whole(self, column: pa.Array) -> np.ndarray:
        flat = column.flatten()
        if self.exact and len(flat) == len(column) * self.width:  # all of the full length
            return np.floor(flat.to_numpy(zero_copy_only=False) * SCALE).reshape(len(column), self.width)
        return np.stack([whole(v, self.width, self.exact) for v in column.to_pylist()])

    def vectors(self, column: pa.Array) -> np.ndarray:
        if self.kind is None:
            rows = [v.decode().split(",") if v else [] for v in column.to_pylist()]
            return np.array([[int(x) for x in r] for r in rows], object).reshape(len(rows), self.width)
        return _fixed(column, self.kind, self.width).astype(np.float64)

    def pack(self, x: np.ndarray) -> pa.Array:
        if self.kind is None:
            return pa.array([",".join(map(str, r)).encode() for r in x.tolist()], pa.binary())
        return _bytes(x.astype(self.kind))


def _fixed(column: pa.Array, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def _bytes(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


_STATE = "v binary, code binary, low binary, stamp binary"


def _first_state(pack: _Packing, books: Codebooks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                x, n = pack.whole(part.column("embedding")), part.num_rows
                state = (np.zeros((n, PARTS), np.uint8), np.zeros((n, PARTS * GROUPS), np.float32), np.zeros((n, PARTS * GROUPS), np.uint8))
                code, low, stamp, _, _ = _renew(books, x, *state)
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("label"), pack.pack(x), _bytes(code), _bytes(low), _bytes(stamp)],
                                                 ["vec_id", "label", "v", "code", "low", "stamp"])
    return run


def _renew(books: Codebooks, x: np.ndarray, code: np.ndarray, low: np.ndarray, stamp: np.ndarray):
    """codes, bounds, stamps, error and distances computed, [row, ...], under the newest codebooks."""
    code, low, stamp = code.copy(), low.copy(), stamp.copy()
    error = np.zeros(len(x), x.dtype)
    done = 0
    for p, part in enumerate(np.split(x, PARTS, axis=1)):
        own = slice(p * GROUPS, (p + 1) * GROUPS)
        best, least, n = assign(part, books, p, code[:, p].astype(np.int64), low[:, own], stamp[:, own], books.moved(p))
        code[:, p] = best
        error = error + least
        done += n
    return code, low, stamp, error, done


def _next_state(pack: _Packing, books: Codebooks, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                x = pack.vectors(part.column("v"))
                state = (_fixed(part.column("code"), np.uint8, PARTS), _fixed(part.column("low"), "<f4", PARTS * GROUPS),
                         _fixed(part.column("stamp"), np.uint8, PARTS * GROUPS))
                code, low, stamp, error, done = _renew(books, x, *state)
                keys = [part.column("vec_id"), part.column("label")]
                if last:
                    errors = [min(int(e), MAX_LONG) for e in error.tolist()]
                    yield pa.RecordBatch.from_arrays([*keys, pa.array([r.tobytes().hex() for r in code], pa.string()), pa.array(errors, pa.int64()),
                                                      pa.array([done // len(x)] * len(x), pa.int64())], ["vec_id", "label", "code", "error", "distances"])
                else:
                    yield pa.RecordBatch.from_arrays([*keys, part.column("v"), _bytes(code), _bytes(low), _bytes(stamp)],
                                                     ["vec_id", "label", "v", "code", "low", "stamp"])
    return run


def _sums(pack: _Packing):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.int64 if pack.exact else object
        total = [np.zeros((ENTRIES, pack.width // PARTS), object) for _ in range(PARTS)]
        count = np.zeros((PARTS, ENTRIES), np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                x, code = pack.vectors(part.column("v")).astype(kind), _fixed(part.column("code"), np.uint8, PARTS)
                for p, own in enumerate(np.split(x, PARTS, axis=1)):
                    order = np.argsort(code[:, p], kind="stable")
                    used, first, n = np.unique(code[order, p], return_index=True, return_counts=True)
                    count[p, used] += n
                    total[p][used] += np.add.reduceat(own[order], first, axis=0).astype(object)
        rows = [(p, int(e), int(count[p, e]), ",".join(map(str, total[p][e]))) for p in range(PARTS) for e in np.flatnonzero(count[p])]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.string()), strict=True)],
                                         ["part", "entry", "n", "sums"])
    return run


def _total(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Sum of the tasks' sums of one entry, in Python integers."""
    sums = [sum(map(int, column)) for column in zip(*[s.split(",") if s else [] for s in rows["sums"]], strict=True)]
    return pd.DataFrame({"part": [key[0]], "entry": [key[1]], "n": [int(rows["n"].sum())], "sums": [",".join(map(str, sums))]})


def _means(state: DataFrame, pack: _Packing, books: Codebooks) -> list[np.ndarray]:
    """The entries moved to the floored means of their parts; unused ones stay."""
    kind = "part int, entry int, n long, sums string"
    found = state.select("v", "code").mapInArrow(_sums(pack), kind).groupBy("part", "entry").applyInPandas(_total, kind)
    out = [p.copy() for p in books.history[-1]]
    for r in found.collect():  # a row for each entry in use
        out[r.part][r.entry] = [int(s) // r.n for s in r.sums.split(",")] if r.sums else []
    return out


def train(vectors: DataFrame) -> tuple[DataFrame, Codebooks | None]:
    """(``vec_id, label, code, error, distances`` of every usable row, the codebooks); ``distances``: distances computed in the
    last assignment per vector of its block.  Without a usable row the codebooks are None."""
    spark = vectors.sparkSession
    rows = (vectors.where(finite()).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), "label"))
    width, limit = rows.agg(F.max(F.size("embedding")), F.max(F.array_max(F.transform("embedding", F.abs)))).collect()[0]
    label = StructField("label", vectors.schema["label"].dataType)
    result = StructType([*StructType.fromDDL("vec_id long").fields, label, *StructType.fromDDL("code string, error long, distances long").fields])
    if width is None:
        return spark.createDataFrame([], result), None
    width, limit = -(-width // PARTS) * PARTS, SCALE * (limit or 0.0) + 1
    # squared distances, and each sum on the way to one, are whole numbers below 2^53
    exact = 4 * limit * limit * max(width, 1) < 2 ** 53
    pack = _Packing(width, exact, limit)
    seeds = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(ENTRIES).select("embedding").collect()
    books = Codebooks.start(np.stack([whole(r.embedding, width, exact) for r in seeds]))
    schema = StructType([*StructType.fromDDL("vec_id long").fields, label, *StructType.fromDDL(_STATE).fields])

    def written(df: DataFrame) -> tuple[DataFrame, str]:
        path = scratch_dir(spark, "vector-codes")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    state, path = written(rows.mapInArrow(_first_state(pack, books), schema))
    for t in range(1, ROUNDS + 1):
        books = books.then(_means(state, pack, books))
        before, old = state, path
        state, path = written(before.mapInArrow(_next_state(pack, books, t == ROUNDS), result if t == ROUNDS else schema))
        drop_table(spark, old)
    return state, books


def compress(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every usable row."""
    codes, books = train(vectors)
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MAX_LONG).cast("decimal(38,0)")).cast("long")
    by_label = codes.groupBy(F.col("label").alias("_label")).agg(total.alias("label_error"))
    return (codes.join(by_label, codes.label.eqNullSafe(by_label["_label"]))
            .select("vec_id", "code", "error", "label_error", F.lit(books.sha256() if books else "").alias("codebooks_sha256")))


def sql() -> str:
    """The same as ``compress`` in DuckDB's SQL, for vectors of one length that is a multiple of four."""
    steps = [f"""WITH given AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT r, part, v[part * (len(v) // {PARTS}) + 1:(part + 1) * (len(v) // {PARTS})] AS x FROM given, range(0, {PARTS}) AS t(part)),
book0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x AS c FROM parts WHERE r <= {ENTRIES})"""]
    for t in range(ROUNDS + 1):
        steps.append(f"""near{t} AS MATERIALIZED (
  SELECT r, part, min(struct_pack(d := list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c), e := entry)) AS b
  FROM parts JOIN book{t} USING (part) GROUP BY r, part)""")
        if t < ROUNDS:
            steps.append(f"""mean{t} AS (
  SELECT part, entry, list(m ORDER BY pos) AS c FROM (
    SELECT part, b.e AS entry, pos, floor(sum(y) / count(*)) AS m
    FROM (SELECT r, part, unnest(x) AS y, generate_subscripts(x, 1) AS pos FROM parts) u JOIN near{t} USING (r, part) GROUP BY part, b.e, pos) w
  GROUP BY part, entry),
book{t + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.c, o.c) AS c FROM book{t} o LEFT JOIN mean{t} m USING (part, entry))""")
    return ",\n".join(steps) + f""",
coded AS (
  SELECT r, string_agg(printf('%02x', b.e), '' ORDER BY part) AS code, sum(b.d)::BIGINT AS error FROM near{ROUNDS} GROUP BY r),
books AS (
  SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT), ','), ',' ORDER BY part, entry)) AS s FROM book{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, s AS codebooks_sha256
FROM given JOIN coded USING (r), books
"""
