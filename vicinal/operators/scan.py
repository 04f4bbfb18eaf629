"""The distributed compare step behind every search.

The query side is *measured* and picks the physical form:

* **broadcast**: the query block fits ``Limits``; each corpus partition streams past it in ``mapInArrow`` and
  emits at most ``k`` rows per query (or every pair within a radius). The corpus is never shuffled.
* **blocks**: more queries than that. They are cut into blocks of that size, each broadcast in turn over the corpus, which is written once. The hits of a block are
  written before the next one starts, so the driver and a task hold one block, and a lost executor costs a task of one block.
* **dealt**: as many queries, but hits that cannot be merged to k rows a query where they are found: matches within a radius, best
  parents, candidates compared on full vectors. The corpus is dealt to every query block by one shuffle; a task holds its block and
  streams the whole corpus past it, so its best are final and matches go out as they are found, unwritten. Where each group's best row is
  wanted, rows come sorted by group, so those are final as well and no match is shuffled.
* **cells**: more queries than that, and only pairs that share a list (an inverted file) or a key may meet. Both sides are then
  shuffled by it, once. A list or key that is larger than a block is cut into cells; the others, however many, need no table.
  A task sees a cell's queries first and streams its corpus rows past them, matches go out as they are found.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vicinal.functions.scores import score_array, to_score
from vicinal.operators.blocks import CELLS, METRIC_OF_SPACE, Hits, Prepared, allowed_pairs, as_bytes, as_matrix, combined, exact_pairs, lower_bounds, pack_vectors, pair_distance, scan_batch, to_words, unpack_vectors, within
from vicinal.operators.tokens import compare_token_sets
from vicinal.plans.limits import LIMITS, Limits, few_partitions, parallelism, query_cap, scratch_dir, vector_length
from vicinal.spec import SpecError


MATCHES = 4_000_000      # matches of a radius search that a task holds before they go out
MATCH_BYTES = 80 << 20   # and their bytes


@dataclass(frozen=True)
class Scan:
    """What the tasks need to know; travels with the plan."""

    metric: str
    space: str
    query_id: str
    query_vec: str
    id: str
    vec: str
    columns: tuple            # corpus columns of the output, the id among them
    order: tuple              # corpus columns that settle equal distances
    k: int | None = None      # None: every pair within the limit
    group: str | None = None  # keep the best k distinct values of this column instead of the best k rows; without k, the best row of each value
    in_order: bool = False    # a task gets the whole corpus, sorted by group and then by the other columns of the output
    conds: tuple = ()         # (query column, operator, corpus column)
    min_score: float | str | None = None
    max_distance: float | str | None = None
    decode: Callable | None = None        # corpus column -> matrix
    encode_query: Callable | None = None  # query matrix -> matrix to compare with
    query_list: str | None = None
    list_column: str | None = None
    counted: bool = False     # hits carry the number of rows that were compared with their query, see ``with_counts``
    full: str | None = None   # corpus column of full vectors: pairs that the codes let through are compared on them in the same task
    exact_limit: tuple | None = None      # (query column, whether it is a distance or else a score) that the exact distance must meet
    packed: tuple = ()        # (corpus column, kind of number) of vectors that travel as bytes

    @property
    def query_columns(self) -> list[str]:
        extra = [c[0] for c in self.conds] + ([self.query_list] if self.query_list else []) + [v for v in (self.min_score, self.max_distance) if isinstance(v, str)]
        extra += [self.exact_limit[0]] if self.exact_limit else []
        return list(dict.fromkeys([self.query_id, self.query_vec, *extra]))

    @property
    def corpus_columns(self) -> list[str]:
        extra = [c[2] for c in self.conds]
        lists = [self.list_column] if self.list_column else []
        full = [self.full] if self.full else []
        return list(dict.fromkeys([*self.columns, *self.order, self.vec, *full, *extra, *lists]))


def _matrix(scan: Scan, column) -> np.ndarray:
    if scan.decode is not None:
        return scan.decode(combined(column))
    return as_bytes(column) if scan.metric == "hamming" else _vectors(scan, scan.vec, column)


def _vectors(scan: Scan, name: str, column) -> np.ndarray:
    kind = dict(scan.packed).get(name)
    return as_matrix(column) if kind is None else unpack_vectors(combined(column), kind)


def _packed(scan: Scan, c: DataFrame) -> tuple[Scan, DataFrame]:
    """Vectors that are only compared travel as bytes: a row is then copied as a whole, not number by number, for each query block."""
    kinds = {"float": "<f4", "double": "<f8"}
    names = [n for n, plain in ((scan.vec, scan.decode is None and scan.metric != "hamming"), (scan.full, True)) if n and plain]
    shown = {*scan.columns, *scan.order, *[cond[2] for cond in scan.conds]}
    mine = {n: kinds.get(t.elementType.typeName()) for n in names if n not in shown and isinstance(t := c.schema[n].dataType, T.ArrayType)}
    mine = {n: kind for n, kind in mine.items() if kind}

    @F.arrow_udf("binary")
    def pack(column: pa.Array) -> pa.Array:
        return pack_vectors(column)

    return replace(scan, packed=tuple(mine.items())), c.withColumns({n: pack(n) for n in mine}) if mine else c


def _query_side(scan: Scan, table: pa.Table):
    column = table.column(scan.query_vec)
    rows = as_bytes(column) if scan.metric == "hamming" and scan.encode_query is None else as_matrix(column)
    if scan.space == "cosinesimil" and scan.encode_query is None and len(rows) and not rows.any(axis=1).all():
        raise SpecError("zero vector is not supported when space is cosinesimil")
    if scan.encode_query is not None:
        rows = scan.encode_query(rows)
    return Prepared(scan.metric, rows)


def _limits(scan: Scan, table: pa.Table):
    """Per-query raw bound for the candidate test, and the exact acceptance test."""
    def values(v):
        if isinstance(v, str):
            return combined(table.column(v)).to_numpy(zero_copy_only=False).astype(np.float64)
        return np.full(table.num_rows, float(v))

    if scan.max_distance is not None:
        return values(scan.max_distance), None
    if scan.min_score is None:
        return None, None
    s = values(scan.min_score)
    if scan.space == "cosinesimil":
        raw = 2.0 - 2.0 * s
    elif scan.space == "innerproduct":
        raw = np.where(s > 1, 1.0 - s, 1.0 / s - 1.0)
    else:
        raw = 1.0 / s - 1.0
    # The candidate test may let a little more through; the score itself decides.
    return raw + np.abs(raw) * 1e-9 + 1e-9, lambda found, q: score_array(found, scan.space) >= s[q]


class _Full:
    """The full vectors beside compared codes: distances of given pairs, and bounds that thin out candidates of a radius search."""

    def __init__(self, scan: Scan, q_table: pa.Table):
        self.scan, self.metric = scan, METRIC_OF_SPACE[scan.space]
        self.q = Prepared(self.metric, as_matrix(q_table.column(scan.query_vec)))
        self.limit = None
        if scan.exact_limit is not None:
            name, by_distance = scan.exact_limit
            self.limit = _limits(replace(scan, **{"max_distance": name, "min_score": None} if by_distance else {"max_distance": None, "min_score": name}), q_table)[0]

    def beside(self, part) -> "_Full":
        out = object.__new__(_Full)
        out.q, out.limit, out.c = self.q, self.limit, Prepared(self.metric, _vectors(self.scan, self.scan.full, part.column(self.scan.full)))
        return out

    def thinned(self, ok: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The candidates that may lie within their query's limit. Where there are few, their distances alone are less work."""
        if self.limit is None or np.count_nonzero(ok) * 64 < ok.size:
            return ok
        return ok & within(lower_bounds(self.q.pick(rows), self.c)[0], self.limit[rows])

    def distances(self, qi: np.ndarray, ci: np.ndarray) -> np.ndarray:
        return exact_pairs(self.q, self.c, qi, ci)


class _Nearest:
    """The nearest row of every group to each query, on a tie the first one, where rows come sorted by group. A group may go on in the next
    batch, so the best rows of a batch's last group wait: at most one a query."""

    def __init__(self, scan: Scan, q_table: pa.Table):
        codes = combined(q_table.column(scan.query_id)).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        self.who = np.unique(codes, return_inverse=True)[1].astype(np.int64)
        self.repeated = len(np.unique(codes)) < len(codes)
        self.group, self.last, self.waiting = scan.group, None, None

    def pieces(self, batch):
        """The batch with the places of its rows and numbers of their groups. A query given twice is merged within one strip of the product,
        so a strip holds all queries then."""
        step = max(1, CELLS // max(1, len(self.who))) if self.repeated else max(1, batch.num_rows)
        for at in range(0, batch.num_rows, step):
            part = pa.Table.from_batches([batch.slice(at, step)])
            code = combined(part.column(self.group)).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            number = np.r_[0, np.cumsum(code[1:] != code[:-1])]
            yield part.append_column("_g", pa.array(number, pa.int32())).append_column("_place", pa.array(np.arange(len(code)), pa.int32()))

    def feed(self, part: pa.Table, strips):
        """The best rows of groups that have ended."""
        values, end = part.column(self.group), part.column("_g")[-1].as_py()
        follows = self.last == (values[0].as_py(),)
        self.last = (values[-1].as_py(),)
        first, last = [], []
        for found in strips:
            g = found.column("_g").to_numpy()
            at = self._least(found, self.who[found.column("_q").to_numpy()] * (end + 1) + g, found.column("_place").to_numpy())
            found, g = found.take(pa.array(at)), g[at]
            begun = (g == 0) if follows else np.zeros(len(g), bool)
            for rows, some in ((first, begun), (last, ~begun & (g == end))):
                if some.any():
                    rows.append(found.filter(pa.array(some)))
            yield found.filter(pa.array(~begun & (g < end)))
        if first:
            both = pa.concat_tables([*([self.waiting] if self.waiting is not None else []), *first])
            self.waiting = both.take(pa.array(self._least(both, self.who[both.column("_q").to_numpy()], np.arange(both.num_rows))))
        if end or not follows:
            yield from self.finish()
            self.waiting = pa.concat_tables(last) if last else None

    def _least(self, found: pa.Table, key: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Where each key's nearest row is, of equally near ones the one whose place comes first."""
        raw, order = found.column("_raw").to_numpy(), np.arange(len(key))
        if self.repeated or (key[1:] < key[:-1]).any():
            order = np.lexsort((place, raw, key))
            key, raw = key[order], raw[order]
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        at = np.flatnonzero(raw == np.repeat(np.minimum.reduceat(raw, start), np.diff(np.append(start, len(key)))))
        return order[at[np.r_[True, key[at[1:]] != key[at[:-1]]]]]

    def finish(self):
        if self.waiting is not None:
            yield self.waiting
        self.waiting = None


class _Comparison:
    """One query block against corpus batches as they come; yields result tables. Matches without a k wait until they are many and go out by
    distance: equal values side by side take a fraction of the space where a result is written, which grows with the square of the table."""

    def __init__(self, scan: Scan, q_table: pa.Table, lists: dict | None = None):
        self.scan, self.q_table, self.lists = scan, q_table, lists
        self.sets = scan.metric == "maxsim"
        self.carried = list(dict.fromkeys([*scan.columns, *scan.order]))
        self.hits = None
        self.seen = np.zeros(q_table.num_rows, np.int64)
        self.ready, self.rows, self.bytes = [], 0, 0
        if self.sets:
            self.hits = Hits(q_table.num_rows, scan.k, scan.order, None, None)
            return
        self.q = _query_side(scan, q_table)
        self.limit, self.accept = _limits(scan, q_table)
        self.full = _Full(scan, q_table) if scan.full else None
        if scan.k is not None:
            self.hits = Hits(self.q.n, scan.k, scan.order, scan.group, self.limit)
        self.nearest = _Nearest(scan, q_table) if scan.in_order else None

    def feed(self, batches):
        scan = self.scan
        if self.sets:
            compare_token_sets(scan, self.q_table, batches, self.hits)
            return
        for batch in batches:
            if not batch.num_rows or not self.q.n:
                continue
            for part, index in _by_list(scan, batch, self.lists):
                if scan.counted:
                    self._count(part, index)
                if self.nearest is None:
                    yield from self._sorted(self._found(part, self.carried, index))
                    continue
                for piece in self.nearest.pieces(part):
                    yield from self._sorted(self.nearest.feed(piece, self._found(piece, [*self.carried, "_g", "_place"], index)))

    def _found(self, part, columns: list, index):
        scan = self.scan
        for found in scan_batch(self.hits, self.q, self.q_table, part, _matrix(scan, part.column(scan.vec)), scan.id, columns,
                                scan.conds, self.limit, self.accept, index, self.full and self.full.beside(part)):
            found = self._within(found) if scan.exact_limit else found
            if found.num_rows:
                yield found

    def _sorted(self, tables, end: bool = False):
        """Matches by distance, as many at a time as a task may hold."""
        for found in tables:
            if self.scan.full:  # what they were found by is of no use any more
                found = found.drop_columns(["_raw"])
            self.ready.append(found)
            self.rows, self.bytes = self.rows + found.num_rows, self.bytes + found.nbytes
            if self.rows >= MATCHES or self.bytes >= MATCH_BYTES:
                yield from self._by_distance()
        if end and self.ready:
            yield from self._by_distance()

    def _by_distance(self):
        left, columns = pa.concat_tables(self.ready), {}
        self.ready, self.rows, self.bytes = [], 0, 0
        for name in left.column_names:  # one column at a time is there twice
            columns[name], left = combined(left.column(name)), left.drop_columns([name])
        order = pa.array(np.argsort(columns["_exact" if self.scan.full else "_raw"].to_numpy()))
        for at in range(0, len(order), 200_000):
            yield pa.table({name: column.take(order.slice(at, 200_000)) for name, column in columns.items()})
        del columns, order
        pa.default_memory_pool().release_unused()  # else a worker keeps it while it waits for its next task

    def _within(self, found: pa.Table) -> pa.Table:
        name, by_distance = self.scan.exact_limit
        least = combined(self.q_table.column(name)).to_numpy(zero_copy_only=False).astype(np.float64)[found.column("_q").to_numpy()]
        exact = found.column("_exact").to_numpy()
        return found.filter(pa.array(exact <= least if by_distance else score_array(exact, self.scan.space) >= least))

    def _count(self, part, index) -> None:
        rows = np.arange(self.q.n) if index is None else index
        if not self.scan.conds:
            self.seen[rows] += part.num_rows
            return
        step = max(1, CELLS // part.num_rows)
        for at in range(0, len(rows), step):
            some = rows[at:at + step]
            self.seen[some] += allowed_pairs(self.scan.conds, self.q_table.take(pa.array(some)), part).sum(axis=1)

    def finish(self):
        if self.hits is None:
            yield from self._sorted(self.nearest.finish() if self.nearest is not None else (), end=True)
        table = self.hits.result() if self.hits is not None else None
        if table is not None:
            if self.scan.counted:
                q = table.column("_q").to_numpy()
                first = np.r_[True, q[1:] != q[:-1]]
                table = table.append_column("_seen", pa.array(np.where(first, self.seen[q], 0)))
            yield table


def _compare(scan: Scan, q_table: pa.Table, batches, lists: dict | None = None):
    """Run one task's corpus batches against one query block; yields result tables."""
    both = _Comparison(scan, q_table, lists)
    yield from both.feed(batches)
    yield from both.finish()


def _by_list(scan: Scan, batch, lists: dict | None):
    """The batch cut by list (or key) together with the query rows that want it; unwanted lists are passed over."""
    if lists is None:
        yield batch, None
        return
    column = combined(batch.column(scan.list_column)).dictionary_encode()
    code = column.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    order = np.argsort(code, kind="stable")
    values = column.dictionary.to_pylist()
    edges = np.searchsorted(code[order], np.arange(len(values) + 1))
    for i, value in enumerate(values):
        index = lists.get(value)
        if index is not None:
            rows = order[edges[i]:edges[i + 1]]
            yield (batch if len(rows) == batch.num_rows else batch.take(pa.array(rows))), index


def _keyed(scan: Scan, q: DataFrame, c: DataFrame) -> Scan:
    """Turn one equality condition into a key, so that only pairs sharing it are ever compared."""
    if scan.list_column is not None:
        return scan
    for cond in scan.conds:
        left, right = q.schema[cond[0]].dataType, c.schema[cond[2]].dataType
        if cond[1] == "==" and left == right and isinstance(left, (T.IntegralType, T.StringType, T.DateType, T.BooleanType)):
            rest = tuple(other for other in scan.conds if other is not cond)
            return replace(scan, conds=rest, query_list=cond[0], list_column=cond[2])
    return scan


def _shape(scan: Scan, q_table: pa.Table, found: pa.Table, schema: pa.Schema) -> pa.Table:
    who = q_table.column(scan.query_id).take(found.column("_q"))
    columns = {scan.query_id: who, **{c: found.column(c) for c in scan.columns}, "distance": found.column("_raw" if "_raw" in found.column_names else "_exact")}
    if scan.counted:
        columns["_seen"] = found.column("_seen")
    if scan.full:
        columns["_exact"] = found.column("_exact")
    return pa.table([combined(columns[f.name]).cast(f.type) for f in schema], schema=schema)


def output_schema(scan: Scan, q: DataFrame, c: DataFrame) -> T.StructType:
    fields = [T.StructField(scan.query_id, q.schema[scan.query_id].dataType)]
    fields += [T.StructField(name, c.schema[name].dataType) for name in scan.columns]
    counts = [T.StructField("_seen", T.LongType())] if scan.counted else []
    exact = [T.StructField("_exact", T.DoubleType())] if scan.full else []
    return T.StructType([*fields, T.StructField("distance", T.DoubleType()), *counts, *exact])


def _broadcast_scan(scan: Scan, q_table: pa.Table, q: DataFrame, c: DataFrame, lists: dict | None):
    """(hits, the broadcast block)."""
    schema = output_schema(scan, q, c)
    arrow = to_arrow_schema(schema)
    held = c.sparkSession.sparkContext.broadcast((q_table, lists))

    def task(batches):
        block, by_list = held.value
        for found in _compare(scan, block, batches, by_list):
            yield from _shape(scan, block, found, arrow).to_batches(max_chunksize=10_000)

    return few_partitions(c.select(*scan.corpus_columns)).mapInArrow(task, schema), held


def scan_pairs(scan: Scan, block: pa.Table, q: DataFrame, pairs: DataFrame) -> DataFrame:
    """Exact distances of given (query, row) pairs against a broadcast query block; a task keeps k rows per query."""
    schema = output_schema(scan, q, pairs)
    arrow = to_arrow_schema(schema)
    held = pairs.sparkSession.sparkContext.broadcast(block.combine_chunks())

    def task(batches):
        table = held.value
        side, ids = _query_side(scan, table), combined(table.column(scan.query_id))
        hits = Hits(side.n, scan.k, scan.order, None, None)
        for batch in batches:
            who = pc.index_in(batch.column(scan.query_id), value_set=ids)
            if who.null_count:
                keep = pc.is_valid(who)
                batch, who = batch.filter(keep), who.filter(keep)
            if not batch.num_rows:
                continue
            qi = who.to_numpy()
            rows = _matrix(scan, batch.column(scan.vec))
            rows = to_words(rows) if scan.metric == "hamming" else rows
            raw = pair_distance(scan.metric, side.rows[qi], rows)
            hits.push(qi, raw, pa.table({n: batch.column(n) for n in scan.columns}))
        found = hits.result()
        if found is not None:
            yield from _shape(scan, table, found, arrow).to_batches(max_chunksize=10_000)

    return pairs.select(scan.query_id, *scan.columns, scan.vec).mapInArrow(task, schema)


def packed_hits(scan: Scan, block: pa.Table, c: DataFrame, lists: dict | None, limits: Limits) -> pa.Table:
    """The best k of every query of a block, merged, on the driver: ``_q`` (row of the block) and the scan's columns, at most
    ``limits.state_rows`` rows. A task sends one row a query, holding its best as lists, and so does the merge."""
    spark = c.sparkSession
    carried = list(dict.fromkeys([*scan.columns, *scan.order]))
    kinds = [c.schema[n].dataType for n in carried]
    schema = T.StructType([T.StructField("_q", T.IntegerType()), T.StructField("_raw", T.ArrayType(T.DoubleType())),
                           *[T.StructField(n, T.ArrayType(k)) for n, k in zip(carried, kinds)]])
    arrow = to_arrow_schema(schema)
    held = spark.sparkContext.broadcast((block, lists))
    k, order, n_q = scan.k, scan.order, block.num_rows

    def packed(found: pa.Table):
        q = found.column("_q").to_numpy()
        starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        offsets = pa.array(np.append(starts, len(q)).astype(np.int32))
        columns = [pa.array(q[starts], pa.int32()), *[pa.ListArray.from_arrays(offsets, combined(found.column(n))) for n in ("_raw", *carried)]]
        table = pa.table([x.cast(f.type) for x, f in zip(columns, arrow)], schema=arrow)
        yield from table.to_batches(max_chunksize=max(1, 1_000_000 // k))

    def task(batches):
        rows, by_list = held.value
        for found in _compare(scan, rows, batches, by_list):
            yield from packed(found)

    def merge(batches):
        hits = Hits(n_q, k, order, None, None)
        for batch in batches:
            if batch.num_rows:
                sizes = batch.column("_raw").value_lengths().to_numpy()
                rows = pa.table({n: batch.column(n).flatten() for n in carried})
                hits.push(np.repeat(batch.column("_q").to_numpy(), sizes), batch.column("_raw").flatten().to_numpy(), rows)
        found = hits.result()
        if found is not None:
            yield from packed(found)

    parts = few_partitions(c.select(*scan.corpus_columns)).mapInArrow(task, schema)
    whole = parts.repartition("_q").mapInArrow(merge, schema).toArrow()
    held.destroy()
    sizes = combined(whole.column("_raw")).value_lengths().to_numpy() if whole.num_rows else np.empty(0, np.int64)
    return pa.table({"_q": np.repeat(whole.column("_q").to_numpy(), sizes), **{n: combined(whole.column(n)).flatten() for n in carried}})


def match_scan(scan: Scan, block: pa.Table, q: DataFrame, c: DataFrame, who: np.ndarray, wanted: pa.Table) -> DataFrame:
    """Exact distances of the pairs (row ``who`` of the block, row of ``c`` with the keys of ``wanted``), found where the rows of ``c``
    lie: pairs of bounded number travel to the scan, so no vector is shuffled or joined. A task keeps k rows per query."""
    schema = output_schema(scan, q, c)
    arrow = to_arrow_schema(schema)
    keys = wanted.column_names[1:]
    h = wanted.column("_h").to_numpy()
    at = np.argsort(h, kind="stable")
    held = c.sparkSession.sparkContext.broadcast((block, h[at], who[at].astype(np.int32), wanted.select(keys).take(pa.array(at)).combine_chunks()))

    def task(batches):
        rows, marks, asking, names = held.value
        side = _query_side(scan, rows)
        hits = Hits(side.n, scan.k, scan.order, None, None)
        for batch in batches:
            mine = batch.column("_h").to_numpy()
            low = np.searchsorted(marks, mine, "left")
            n = np.searchsorted(marks, mine, "right") - low
            row = np.repeat(np.arange(len(mine)), n)
            if not len(row):
                continue
            pair = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
            same = np.ones(len(row), bool)
            for key in keys:
                same &= pc.equal(batch.column(key).take(pa.array(row)), combined(names.column(key)).take(pa.array(pair))).to_numpy(zero_copy_only=False)
            row, pair = row[same], pair[same]
            there, place = np.unique(row, return_inverse=True)
            if not len(there):
                continue
            some = batch.take(pa.array(there))
            vectors = _matrix(scan, some.column(scan.vec))
            vectors = to_words(vectors) if scan.metric == "hamming" else vectors
            raw = pair_distance(scan.metric, side.rows[asking[pair]], vectors[place])
            hits.push(asking[pair], raw, pa.table({n: some.column(n).take(pa.array(place)) for n in scan.columns}))
        found = hits.result()
        if found is not None:
            yield from _shape(scan, rows, found, arrow).to_batches(max_chunksize=10_000)

    read = list(dict.fromkeys([*scan.columns, *keys, scan.vec]))
    return c.select(*read, key_hash(keys).alias("_h")).mapInArrow(task, schema)


def key_hash(keys):
    return F.xxhash64(*[F.col(k) for k in keys])


def _cells(n: int, rows: int) -> int:
    return max(1, -(-n // max(1, rows)))


def _block_scan(scan: Scan, q: DataFrame, c: DataFrame, dim: int, limits: Limits) -> DataFrame:
    """Query blocks of bounded size, broadcast one after another over the corpus where it lies. A block's best k are merged before
    they are written; the blocks together are one table of hits. The corpus is written first, so that what it derives from (codes, changes)
    is computed once and not for each block; hits carry the number of their row, by which wide columns (vectors, texts) join the merged hits alone."""
    spark = c.sparkSession
    whole, asked, out, rows = scan, *[scratch_dir(spark, n) for n in ("query-blocks", "hits", "corpus")]
    wide = [n for n in scan.columns if n not in scan.order and isinstance(c.schema[n].dataType, (T.ArrayType, T.BinaryType, T.StringType, T.StructType, T.MapType))]
    c = c.select(*scan.corpus_columns)
    if wide:
        c = c.withColumn("_row", F.monotonically_increasing_id())
        scan = replace(scan, columns=(*[n for n in scan.columns if n not in wide], "_row"))
    schema = c.schema
    c.write.parquet(rows)
    # A task sends k rows a query to the merge, so there are no more tasks than cores.
    c = spark.read.schema(schema).parquet(rows).coalesce(parallelism(spark))
    q = q.select(*scan.query_columns)
    cap = query_cap(dim, scan.k or 1, limits)
    blocks = _cells(q.count(), cap)
    marked = q.withColumn("_block", F.pmod(F.xxhash64(scan.query_id), F.lit(blocks)).cast("int"))
    marked.repartition("_block").write.partitionBy("_block").parquet(asked)
    written = spark.read.schema(marked.schema).parquet(asked)
    for n in range(blocks):
        block = written.where(F.col("_block") == n).drop("_block").toArrow().combine_chunks()
        if not block.num_rows:
            continue
        hits, held = _broadcast_scan(scan, block, q, c, None)
        if scan.counted:
            hits = with_counts(hits, scan.query_id, "_seen")
        hits = merge_top_k(hits, scan.k, scan.query_id, list(scan.order))
        if scan.counted:
            hits = hits.withColumn("_seen", F.when(F.col("rank") == 1, F.col("_seen")).otherwise(0))
        hits = hits.drop("rank")
        hits.write.mode("append").parquet(out)
        held.destroy()
    found = spark.read.schema(output_schema(scan, q, c)).parquet(out)
    if wide:
        found = found.join(c.select("_row", *wide), "_row").select(*output_schema(whole, q, c).names)
    return found


def _dealt_scan(scan: Scan, q: DataFrame, c: DataFrame, dim: int, limits: Limits) -> DataFrame:
    """Query blocks of bounded size, as many as keep the cores busy; every block meets the whole corpus in one task."""
    q, c = q.select(*scan.query_columns), c.select(*scan.corpus_columns)
    blocks = max(_cells(q.count(), query_cap(dim, scan.k or 1, limits)), 2 * parallelism(c.sparkSession))
    scan, c = _packed(scan, c)
    left = q.withColumn("_block", F.pmod(F.xxhash64(scan.query_id), F.lit(blocks)).cast("int"))
    right = c.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    order = [scan.group, *[n for n in scan.columns if n != scan.group]] if scan.in_order else []
    return _meet(scan, left, right, q, c, ["_block"], lambda both: both.repartitionById(blocks, F.col("_block")), order)


def _cell_scan(scan: Scan, q: DataFrame, c: DataFrame, dim: int, limits: Limits) -> DataFrame:
    """Pairs that share a list or key. Rows of both sides meet by one shuffle; each cell's queries come first."""
    per_query = query_cap(dim, scan.k or 1, limits)
    per_corpus = max(1, limits.block_bytes // (8 * max(1, dim)))
    q = q.select(*scan.query_columns).withColumn("_list", F.col(scan.query_list)).where(F.col("_list").isNotNull())
    c = c.select(*scan.corpus_columns).withColumn("_list", F.col(scan.list_column)).where(F.col("_list").isNotNull())

    def large(side: DataFrame, rows: int, name: str) -> DataFrame:
        return side.groupBy("_list").agg(F.ceil(F.count("*") / F.lit(rows)).cast("int").alias(name)).where(F.col(name) > 1)

    # At most one row a full block of either side: few, whatever the number of keys.
    cut_up = F.broadcast(large(q, per_query, "_nq").join(large(c, per_corpus, "_nc"), "_list", "full"))

    def spread(side: DataFrame, key: tuple, own: str, other: str) -> DataFrame:
        own_n, other_n = ("_nq", "_nc") if own == "_qb" else ("_nc", "_nq")
        sized = side.join(cut_up, "_list", "left").withColumns({n: F.coalesce(n, F.lit(1)) for n in ("_nq", "_nc")})
        return (sized.withColumn(own, F.pmod(F.xxhash64(*key), F.col(own_n)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_n) - 1))))

    left, right = spread(q, (scan.query_id,), "_qb", "_cb"), spread(c, scan.order, "_cb", "_qb")
    where = ["_list", "_qb", "_cb"]
    return _meet(scan, left, right, q, c, where, lambda both: both.repartition(*where))


def _meet(scan: Scan, left: DataFrame, right: DataFrame, q: DataFrame, c: DataFrame, where: list, deal: Callable, order=()) -> DataFrame:
    """Hits of the queries ``left`` and the corpus rows ``right`` that share the cell columns ``where``; ``deal`` brings them together.
    A cell's corpus rows come sorted by ``order``."""
    schema = output_schema(scan, q, c)
    arrow = to_arrow_schema(schema)

    def tagged(side: DataFrame, mine: str, columns: list, mark: int) -> DataFrame:
        return side.select(*where, F.lit(mark).alias("_side"), F.struct(*columns).alias(mine))

    left, right = tagged(left, "_q", scan.query_columns, 0), tagged(right, "_c", scan.corpus_columns, 1)
    both = left.withColumn("_c", F.lit(None).cast(right.schema["_c"].dataType)).unionByName(
        right.withColumn("_q", F.lit(None).cast(left.schema["_q"].dataType)))

    def task(batches):
        block, parts, held, now = None, [], None, None

        def shaped(tables):
            for found in tables:
                yield from _shape(scan, block, found, arrow).to_batches(max_chunksize=10_000)

        for cell, side, rows in _runs(batches, where):
            if cell != now:
                if held is not None:
                    yield from shaped(held.finish())
                block, parts, held, now = None, [], None, cell
            if side == 0:
                parts.append(rows)
            elif parts:
                if held is None:
                    block = pa.Table.from_batches(parts).combine_chunks()
                    held = _Comparison(scan, block)
                yield from shaped(held.feed([rows]))
        if held is not None:
            yield from shaped(held.finish())

    return deal(both).sortWithinPartitions(*where, "_side", *[F.col("_c")[n] for n in order]).mapInArrow(task, schema)


def _runs(batches, where: list):
    """(cell, side, rows of that side) of sorted batches, cut where either changes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.ones(batch.num_rows, bool)
        change[1:] = False
        for name in [*where, "_side"]:
            column = batch.column(name)
            change[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        at = np.append(np.flatnonzero(change), batch.num_rows).tolist()
        keys = list(zip(*[batch.column(name).take(pa.array(at[:-1])).to_pylist() for name in [*where, "_side"]]))
        for (*cell, side), start, stop in zip(keys, at, at[1:]):
            rows = batch.column("_c" if side else "_q").slice(start, stop - start)
            yield tuple(cell), side, pa.RecordBatch.from_struct_array(rows)


def query_block(scan: Scan, q: DataFrame, limits: Limits):
    """``(block, dim)``: the whole query side if it fits the limits, else no block; no dim for an empty table.

    The first read takes at most ``small`` rows, which is bounded at any allowed dimension, so most searches learn
    size, width and content in one job.
    """
    q = q.select(*scan.query_columns)
    sets = isinstance(q.schema[scan.query_vec].dataType, T.ArrayType) and isinstance(
        q.schema[scan.query_vec].dataType.elementType, T.ArrayType)
    small = min(limits.query_rows, 4096, max(1, limits.state_rows // (scan.k or 1)))
    if not sets:
        block = q.limit(small + 1).toArrow()
        if not block.num_rows:
            return None, None
        dim = max(1, block.column(scan.query_vec)[0].as_buffer().size if scan.metric == "hamming" and pa.types.is_binary(
            block.column(scan.query_vec).type) else len(block.column(scan.query_vec)[0]))
        cap = query_cap(dim, scan.k or 1, limits)
        if block.num_rows <= small:
            return (block if block.num_rows <= cap else None), dim
    else:
        # Rows hold differing numbers of vectors, so the widest row has to be known before anything is fetched.
        dim = vector_length(q, scan.query_vec)
        if dim is None:
            return None, None
        cap = query_cap(dim, scan.k or 1, limits)
    block = q.limit(cap + 1).toArrow()
    return (block if block.num_rows <= cap else None), dim


def block_lists(scan: Scan, block: pa.Table, q: DataFrame, c: DataFrame, probes):
    """(scan, corpus, lists) of a block: which of its rows want a list or key, and the corpus without unwanted lists."""
    if probes is not None:
        rows, numbers = probes.block(block.column(scan.query_vec))
        lists = {int(n): rows[numbers == n] for n in np.unique(numbers)}
        return scan, probes.prune(c, list(lists)), lists
    keyed = _keyed(scan, q, c)
    if keyed.query_list is not None:
        groups: dict = {}
        for i, key in enumerate(block.column(keyed.query_list).to_pylist()):
            if key is not None:
                groups.setdefault(key, []).append(i)
        # With very many keys a batch would fall into tiny pieces; comparing under a mask is cheaper then.
        if len(groups) <= 256:
            return keyed, c, {key: np.array(rows) for key, rows in groups.items()}
    return scan, c, None


def run_scan(scan: Scan, q: DataFrame, c: DataFrame, *, probes: Callable | None = None, limits: Limits = LIMITS):
    """Unmerged hits ``(query_id, columns..., distance)`` and whether a task emitted at most k per query.

    ``probes(q_block)`` maps query rows to ``(row, list)`` pairs for an inverted file. Without a k, hits of a ``group`` are merged: the
    nearest row of each group to each query.
    """
    if scan.k is None and scan.group is not None:
        found, merged = _run_scan(scan, q, c, probes, limits)
        return found if merged else best_rows(found, scan.query_id, scan.group, [n for n in scan.columns if n != scan.group])
    return _run_scan(scan, q, c, probes, limits)[0]


def best_rows(hits: DataFrame, query_id: str, group: str, rest) -> DataFrame:
    """The nearest row of each group to each query, on a tie the least in the columns ``rest``."""
    best = F.min(F.struct("distance", *rest)).alias("_b")
    return hits.groupBy(query_id, group).agg(best).select(query_id, group, *[F.col(f"_b.{n}").alias(n) for n in ("distance", *rest)])


def _equal_by_value(kind: T.DataType) -> bool:
    """Whether Spark groups values of a type as they are compared here."""
    return isinstance(kind, (T.IntegralType, T.BooleanType, T.DateType, T.TimestampType, T.DecimalType)) or kind == T.StringType()


def _run_scan(scan: Scan, q: DataFrame, c: DataFrame, probes: Callable | None, limits: Limits):
    """Hits, and whether those of a group are merged."""
    spark = c.sparkSession
    c = c.where(F.col(scan.vec).isNotNull())
    q = q.where(F.col(scan.query_vec).isNotNull())
    block, dim = query_block(scan, q, limits)
    if dim is None:
        return spark.createDataFrame([], output_schema(scan, q, c)), True
    if block is not None:
        block = block.combine_chunks()
        scan, c, lists = block_lists(scan, block, q, c, probes)
        return _broadcast_scan(scan, block, q, c, lists)[0], False
    if probes is not None:
        q = probes.explode(q, scan.query_vec)
        scan = replace(scan, query_list=probes.column)
    else:
        scan = _keyed(scan, q, c)
    if scan.query_list is not None:
        return _cell_scan(scan, q, c, dim, limits), False
    if scan.k is not None and scan.group is None and scan.full is None:
        return _block_scan(scan, q, c, dim, limits), False
    in_order = scan.k is None and scan.group is not None and all(map(_equal_by_value, (q.schema[scan.query_id].dataType, c.schema[scan.group].dataType)))
    return _dealt_scan(replace(scan, in_order=in_order), q, c, dim, limits), in_order


def top_k(hits: DataFrame, k: int, query_id, order: list, *, rank: str = "rank") -> DataFrame:
    """Best k rows per query. Spark adds a per-partition limit below the shuffle for this shape of filter."""
    w = Window.partitionBy(*([query_id] if isinstance(query_id, str) else query_id)).orderBy(F.col("distance"), *[F.col(c) for c in order])
    return hits.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def with_counts(hits: DataFrame, query_id: str, name: str) -> DataFrame:
    """``name``: how many rows were compared with each query, added up over the tasks, which counted them. A task puts its count of a query
    on that query's first hit; a query that met a row has a hit."""
    return hits.withColumn(name, F.sum("_seen").over(Window.partitionBy(query_id)))


def merge_top_k(hits: DataFrame, k: int, query_id: str, order: list) -> DataFrame:
    """Global best k per query out of per-task bests; in two steps where one query could get very many rows."""
    if 4 * parallelism(hits.sparkSession) * k > 1_000_000:
        hits = top_k(hits.withColumn("_salt", F.spark_partition_id() % 64), k, [query_id, "_salt"], order).drop("_salt", "rank")
    return top_k(hits, k, query_id, order)


def with_score(hits: DataFrame, space: str, boost: float = 1.0) -> DataFrame:
    score = to_score("distance", space)
    return hits.withColumn("score", score if boost == 1.0 else score * F.lit(float(boost)))
