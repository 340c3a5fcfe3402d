"""One model per bucket, fitted for all buckets at once.

Rows with a null or NaN label or feature are left out of every fit (listwise).

* Linear models: one ``groupBy(bucket)`` of cross-product sums (normal
  equations), solved per bucket on the already-aggregated rows.
* Regression trees grow level by level, all buckets together. Features are cut
  at quantiles, from mergeable summaries. Rows then become blocks of one group
  (bins, copies and label as compressed planes of bytes), which alone are
  shuffled and written. A level is one job: each task walks a group's rows down
  the splits found so far, tree by tree, so that a node's histogram leaves the
  task once for many rows; the histograms, not rows, are shuffled and summed in
  stages of bounded groups, and the best split of each node comes back,
  groups x 2^level rows at most. Of two siblings the one with fewer rows is
  counted; the other's histogram is what their parent's has left. A split tells
  its children's totals, so leaves need no pass of their own.
* Forests weight a row's bootstrap copies: a byte per tree beside the row, from
  an MD5 of row key and tree, so any engine draws the same; copies are never rows.
  Tasks make the MD5s of a batch of keys together (``key_hashes``).
* Scoring broadcasts the splits (groups x 2^(depth+1), a bound set by
  parameters) and walks all trees at once in Arrow batches.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..operators.features import bucket_of, with_bucket
from ..session import freed_shuffles, join_small, local_table, materialize, materialize_next, scratch_scope
from .key_hashes import KeyTexts
from .quantiles import edges_and_shares
from .staged_merge import FAN_IN, merge_in_stages, task_count

MIN_GAIN = 1e-9
# Of splits whose gains differ by less than this share, the first feature and bin wins: sums in another order change nothing.
GAIN_TIE = 1e-9
# Bytes of unpacked rows that a task holds before it packs them, or walks them; of packed ones that wait; rows of a block and of a task.
PACK_BYTES, CHUNK_BYTES, WAITING_BYTES = 64 << 20, 160 << 20, 64 << 20
ROWS_A_BLOCK, ROWS_A_TASK = 1 << 15, 1 << 20
# Histograms are counted for features together whose bins make at most so many combinations, times the nodes counted;
# for features of a context together at so many combinations at least, or at a share of the rows.
JOINT_CELLS, CONTEXT_CELLS = 1 << 13, 1 << 10
# Bytes of a group's histograms that a task adds to before it hands them on, and of sums by context that are folded together.
HELD_BYTES, FOLD_BYTES = 128 << 20, 32 << 20
# Rows that are walked and counted together, so that what a tree needs of them stays in a core's cache; rows of a one-hot table of context.
PIECE_ROWS, FOLD_ROWS = 1 << 16, 1 << 12
NODES_A_GROUP = 256
# Bytes of histograms that are added up in one group.
GROUP_BYTES = 64 << 20
# Rows x trees that are walked at once.
WALK_CELLS = 1 << 20


def complete_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows without a null or NaN in ``cols``; only columns of floating types are asked for NaN."""
    keep = F.lit(True)
    types = dict(df.dtypes)
    for c in cols:
        keep = keep & F.col(c).isNotNull()
        if types[c] in ("double", "float"):
            keep = keep & ~F.isnan(c)
    return df.where(keep)


# ---------------------------------------------------------------------------
# linear models
# ---------------------------------------------------------------------------

def lr_moments(df: DataFrame, features: list[str], label: str, group: str = "bucket") -> DataFrame:
    """Per group, in one pass over complete rows: n, means (m_i) and population co-moments (c_i_j, i <= j).

    Columns are the features then the label. ``avg`` and ``covar_pop`` merge
    partial results with the pairwise update formulas, so the co-moments are
    numerically stable without a separate centring pass over the input.
    """
    cols = list(features) + [label]
    aggs = [F.count("*").alias("n")]
    aggs += [F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)]
    for i, a in enumerate(cols):
        for j in range(i, len(cols)):
            aggs.append(F.covar_pop(a, cols[j]).alias(f"c_{i}_{j}"))
    return complete_rows(df, cols).groupBy(group).agg(*aggs)


def _solve_lr(features: list[str], group: str):
    p = len(features)

    def solve(batches):
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                r = r._asdict()
                C = np.zeros((p + 1, p + 1))
                for i in range(p + 1):
                    for j in range(i, p + 1):
                        C[i, j] = C[j, i] = r[f"c_{i}_{j}"]
                m = np.array([r[f"m_{i}"] for i in range(p + 1)], dtype=float)
                Sxx, Sxy = C[:p, :p], C[:p, p]
                beta = np.linalg.pinv(Sxx) @ Sxy  # least-norm when singular
                intercept = m[p] - float(beta @ m[:p])
                rows.append((r[group], "intercept", float(intercept)))
                rows += [(r[group], f, float(b)) for f, b in zip(features, beta)]
            yield pd.DataFrame(rows, columns=[group, "term", "coef"])

    return solve


def fit_local_lr(train: DataFrame, features: list[str], label: str, n_buckets: int | None = None,
                 key: str = "trip_id", group: str = "bucket") -> DataFrame:
    """Model table (bucket, term, coef): ordinary least squares per bucket."""
    df = with_bucket(train, n_buckets, key, group) if n_buckets else train
    mom = lr_moments(df, features, label, group)
    schema = f"{group} {dict(mom.dtypes)[group]}, term string, coef double"
    return mom.mapInPandas(_solve_lr(list(features), group), schema)


def mean_coefficients(models: DataFrame) -> dict[str, float]:
    """Average coefficient per term over buckets (p+1 numbers)."""
    return {r["term"]: float(r["coef"]) for r in models.groupBy("term").agg(F.avg("coef").alias("coef")).collect()}


def score_lr_ensemble(models: DataFrame, df: DataFrame, out: str = "prediction") -> DataFrame:
    """Mean of every bucket's prediction, as one linear expression (JVM-side)."""
    coef = mean_coefficients(models)
    expr = F.lit(coef.get("intercept", 0.0))
    for term, b in coef.items():
        if term != "intercept":
            expr = expr + F.col(term) * F.lit(b)
    return df.withColumn(out, expr)


# ---------------------------------------------------------------------------
# regression trees
# ---------------------------------------------------------------------------

class TreeModels:
    """Trees of all groups in arrays by (group, heap node): root 1, children 2n and 2n + 1.

    A row goes left where its feature is at most the split's threshold.
    """

    def __init__(self, groups: list[int], features: list[str], edges: list[np.ndarray], depth: int, group: str):
        size = (len(groups), 2 ** (depth + 1))
        self.groups, self.features, self.edges, self.depth, self.group = groups, features, edges, depth, group
        self.feature, self.bin = np.full(size, -1), np.zeros(size, np.int64)
        self.n, self.s, self.gain = np.zeros(size), np.zeros(size), np.zeros(size)

    def value(self) -> np.ndarray:
        return self.s / np.maximum(self.n, 1e-300)

    def right_is_less(self) -> np.ndarray:
        """By group and node above the last level: whether its right child has fewer rows."""
        return self.n[:, 1::2] < self.n[:, ::2]

    def nodes(self, spark: SparkSession) -> DataFrame:
        """(group, node, level, n, s, feature, bin, gain, value, feature_name, threshold), one row per node."""
        rows = []
        for g, name in enumerate(self.groups):
            for node in np.flatnonzero(self.n[g] > 0).tolist():
                f = int(self.feature[g, node])
                split = f >= 0
                b = int(self.bin[g, node])
                rows.append((int(name), node, node.bit_length() - 1, float(self.n[g, node]), float(self.s[g, node]), f if split else None,
                             b if split else None, float(self.gain[g, node]) if split else None, float(self.s[g, node] / self.n[g, node]),
                             self.features[f] if split else None, float(self.edges[f][b]) if split else None))
        return spark.createDataFrame(rows, f"{self.group} int, node bigint, level int, n double, s double, feature int, bin int, gain double, "
                                           "value double, feature_name string, threshold double")


def _binned(columns: list[np.ndarray], edges: list[np.ndarray]) -> np.ndarray:
    """Bins by row and feature: how many cut points lie below the value."""
    return np.stack([np.searchsorted(e, x, "left") for x, e in zip(columns, edges)], axis=1)


def _bin_planes(columns: list[np.ndarray], edges: list[np.ndarray], bin_type: type) -> np.ndarray:
    """``_binned`` by feature and row."""
    out = np.empty((len(columns), len(columns[0]) if columns else 0), bin_type)
    for i, (x, e) in enumerate(zip(columns, edges)):
        out[i] = np.searchsorted(e, x, "left")
    return out


def _walk(bins: np.ndarray, tree: np.ndarray, feature: np.ndarray, split: np.ndarray, levels: int) -> np.ndarray:
    """The node that each row reaches in its tree after so many levels; it stays at a leaf."""
    node, rows = np.ones(len(bins), np.int64), np.arange(len(bins))
    for _ in range(levels):
        f = feature[tree, node]
        go = bins[rows, np.maximum(f, 0)] > split[tree, node]
        node = np.where(f >= 0, 2 * node + go, node)
    return node


# Fixed rule: Poisson(1) probabilities, summed until a share of 32 bits holds no more of them.
POISSON1 = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(13)])
TREES_A_HASH = 4  # 32 of its 128 bits each


# A share of 32 bits, as a whole number, has so many copies as it reaches of these.
POISSON1_STEPS = [np.uint32(math.ceil(p * 2.0**32)) for p in POISSON1 if math.ceil(p * 2.0**32) < 2**32]


def key_text(key: str) -> Column:
    """What buckets and bootstrap copies are drawn from."""
    return F.coalesce(F.col(key).cast("string"), F.lit("null"))


def bootstrap_hashes(key: str, trees: int) -> Column:
    """Binary column: 4 bytes per tree, MD5s of ``bootstrap:<number>:<key>`` put together."""
    return F.unhex(F.concat(*[F.md5(F.concat(F.lit(f"bootstrap:{i}:"), key_text(key))) for i in range(-(-trees // TREES_A_HASH))]))


def bootstrap_bits(texts: KeyTexts, trees: int) -> np.ndarray:
    """``bootstrap_hashes`` drawn inside a task, as 32-bit numbers by tree and row."""
    hashes = texts.md5([f"bootstrap:{i}:" for i in range(-(-trees // TREES_A_HASH))])
    return hashes.reshape(TREES_A_HASH * len(hashes), -1)[:trees]


def poisson_weights(hashes: np.ndarray) -> np.ndarray:
    """Bootstrap copies, Poisson(1), from unsigned 32-bit hashes."""
    copies = np.zeros(hashes.shape, np.uint8)
    for step in POISSON1_STEPS:
        copies += hashes >= step
    return copies


def _planes(columns: np.ndarray) -> bytes:
    return np.ascontiguousarray(columns.reshape(len(columns), -1).view(np.uint8).T).tobytes()


def _bin_type(edges: list[np.ndarray]) -> type:
    return np.uint16 if max((len(e) for e in edges), default=0) >= 256 else np.uint8


def _rows_of_bytes(column: pa.Array, width: int) -> np.ndarray:
    """Bytes by row of a binary column whose values all have ``width`` of them."""
    fixed = column.cast(pa.binary(width))
    return np.frombuffer(fixed.buffers()[1], np.uint8, len(fixed) * width, fixed.offset * width).reshape(len(fixed), width)


def _context_codes(side: DataFrame, edges: list[np.ndarray], features: list[int]) -> DataFrame:
    """(place, c): the bins of ``features``, in columns x<number> of ``side``, as one binary."""
    cuts, bin_type = [edges[i] for i in features], _bin_type(edges)

    def run(batches):
        for b in batches:
            bins = _binned([c.to_numpy() for c in b.columns[1:]], cuts).astype(bin_type)
            yield pa.record_batch([b.column(0), pa.array([r.tobytes() for r in bins], pa.binary())], ["place", "c"])

    return side.select("place", *[f"x{i}" for i in features]).mapInArrow(run, "place bigint, c binary")


def _packed(rows: DataFrame, edges: list[np.ndarray], own: list[int], trees: int, buckets: int, shares: tuple[np.ndarray, np.ndarray],
            tasks: int) -> DataFrame:
    """Rows (g, w, y, x..) as blocks (task, g, n, block) of a group: context, bins, bootstrap copies and labels.

    Columns x hold the features ``own``; the others, if any, come as bins in a last column (``_context_codes``), of which
    a block holds each distinct one once, and a number of two bytes for a row. ``w`` is the text of a row's key; with
    ``buckets`` it gives the group too.
    Groups are laid out one after the other by their sizes ``shares``, and the
    layout is cut into ``tasks`` equal parts: a part meets few groups, and a
    hot group is dealt over several.
    """
    values, sizes = shares
    ends, total = np.cumsum(sizes), max(int(sizes.sum()), 1)
    bin_type, n_others = _bin_type(edges), len(edges) - len(own)
    out = pa.schema([("task", pa.int32()), ("g", pa.int32()), ("n", pa.int32()), ("block", pa.binary())])

    def run(batches):
        from pyspark import TaskContext

        part, made, held, size = TaskContext.get().partitionId(), 0, [], 0

        def hand_on():
            nonlocal made
            g, y, bins, copies = (np.concatenate(x, axis=-1) for x in list(zip(*held))[:4])
            if n_others:
                context = pa.chunked_array([h[4] for h in held]).combine_chunks().dictionary_encode()
                code, table = context.indices.to_numpy(), _rows_of_bytes(context.dictionary, n_others * bins.itemsize)
            held.clear()
            # neighbours alike pack well, but where context tells most of it apart, they have its numbers in common already
            order = np.argsort(g, kind="stable") if n_others else np.lexsort((*bins, g))
            g = g[order]
            first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            for at, end in zip(first.tolist(), [*first[1:].tolist(), len(g)]):
                cell = min(int(np.searchsorted(values, g[at], "left")), len(ends) - 1)
                for i in range(at, end, ROWS_A_BLOCK):
                    some = order[i:min(i + ROWS_A_BLOCK, end)]
                    made += 1
                    place = ends[cell] - sizes[cell] * ((part * 0.7548776662466927 + made * 0.6180339887498949) % 1.0)
                    data = bins[:, some].tobytes() + copies[:, some].tobytes() + _planes(y[some])
                    if n_others:
                        used, number = np.unique(code[some], return_inverse=True)
                        data = len(used).to_bytes(4, "little") + table[used].tobytes() + _planes(number.astype("<u2")) + data
                    block = zstandard.compress(data, 1)
                    yield pa.record_batch([pa.array([min(int(place * tasks / total), tasks - 1)], pa.int32()), pa.array([g[at]], pa.int32()),
                                           pa.array([len(some)], pa.int32()), pa.array([block], pa.binary())], schema=out)

        for b in batches:
            b = b.filter(b.column(0).is_valid())
            if not b.num_rows:
                continue
            texts = KeyTexts(b.column(1)) if trees or buckets else None
            g = texts.buckets(buckets) if buckets else b.column(0).to_numpy()
            copies = poisson_weights(bootstrap_bits(texts, trees)) if trees else np.zeros((0, b.num_rows), np.uint8)
            bins = _bin_planes([c.to_numpy() for c in b.columns[3:3 + len(own)]], [edges[i] for i in own], bin_type)
            held.append((g, b.column(2).to_numpy(), bins, copies, b.columns[-1]))
            size += sum(x.nbytes for x in held[-1])
            if size > PACK_BYTES:
                yield from hand_on()
                size = 0
        if held:
            yield from hand_on()

    return rows.mapInArrow(run, "task int, g int, n int, block binary").repartitionById(tasks, F.col("task")).drop("task")


def _unpacked(blocks: list[tuple[int, bytes]], n_own: int, n_others: int, trees: int, wide: bool) -> tuple[np.ndarray, ...]:
    """A group's blocks as bins by own feature and row, copies by tree and row, labels, distinct contexts (bins), and their number by row."""
    n, at, bin_type = sum(k for k, _ in blocks), 0, np.dtype(np.uint16 if wide else np.uint8)
    bins, copies, y = np.empty((n_own, n), bin_type), np.empty((trees, n), np.uint8), np.empty((n, 8), np.uint8)
    tables, number, width, known = [np.empty((0, n_others * bin_type.itemsize), np.uint8)], np.zeros(n, np.int64), n_others * bin_type.itemsize, 0
    for k, block in blocks:
        data, own = np.frombuffer(zstandard.decompress(block), np.uint8), slice(at, at + k)
        if n_others:
            d = int.from_bytes(data[:4].tobytes(), "little")
            tables.append(data[4:4 + d * width].reshape(d, width))
            data = data[4 + d * width:]
            number[own] = np.ascontiguousarray(data[:2 * k].reshape(2, k).T).view("<u2").ravel()
            number[own] += known
            data, known = data[2 * k:], known + d
        cut = n_own * k * bin_type.itemsize
        bins[:, own] = data[:cut].view(bin_type).reshape(n_own, k)
        copies[:, own], y[own] = data[cut:cut + trees * k].reshape(trees, k), data[cut + trees * k:].reshape(8, k).T
        at += k
    table = np.concatenate(tables)
    if n_others:
        found = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), known, [None, pa.py_buffer(table)]).dictionary_encode()
        number, table = found.indices.to_numpy()[number].astype(np.int64), _rows_of_bytes(found.dictionary, width)
    return bins, copies, y.view(float).ravel(), table.view(bin_type), number


def _joint(widths: list[int], cells: int) -> list[list[int]]:
    """Features put together, widest first, while their bins make at most ``cells`` combinations."""
    sets: list[tuple[list[int], int]] = []
    for f in sorted(range(len(widths)), key=lambda f: -widths[f]):
        for i, (own, size) in enumerate(sets):
            if size * widths[f] <= cells:
                sets[i] = own + [f], size * widths[f]
                break
        else:
            sets.append(([f], widths[f]))
    return [own for own, _ in sets]


def _context_sets(table: np.ndarray, features: list[int], widths: list[int], most: int) -> list[tuple[list[int], np.ndarray | None, np.ndarray]]:
    """Features put together while at most ``most`` combinations of their bins occur: (features, combination by context, bins by combination).

    Context is the same for many rows, and its features follow from few of it (a date), so that often one set holds all.
    """
    if len(table) <= most:
        return [(features, np.arange(len(table)), table)] if features else []
    sets: list[tuple[list[int], np.ndarray]] = []
    for j, f in enumerate(features):
        for i, (own, number) in enumerate(sets):
            found, joined = np.unique(number * widths[f] + table[:, j], return_inverse=True)
            if len(found) <= most:
                sets[i] = own + [j], joined
                break
        else:
            sets.append(([j], np.unique(table[:, j], return_inverse=True)[1]))
    return [([features[j] for j in own], number, table[np.unique(number, return_index=True)[1]][:, own]) for own, number in sets]


def _folded(sums: np.ndarray, table: np.ndarray, widths: list[int]) -> np.ndarray:
    """Sums by row and combination as sums by row and bin, the features of ``table`` one after the other."""
    starts = np.cumsum([0, *widths])
    out = np.zeros((len(sums), starts[-1]))
    for at in range(0, len(table), FOLD_ROWS):
        some = table[at:at + FOLD_ROWS]
        hot = np.zeros((len(some), starts[-1]))
        hot[np.arange(len(some))[:, None], starts[:-1] + some] = 1
        out += sums[:, at:at + FOLD_ROWS] @ hot
    return out


def _places(planes: np.ndarray, feature: np.ndarray, split: np.ndarray, right: np.ndarray, level: int) -> np.ndarray:
    """By row, 1 + the place of its node in the level above, where the row goes on to that node's child that is counted; else 0.

    At level 0, 1 for all rows.
    """
    n, above = planes.shape[1], 1 << level >> 1
    out = np.zeros(n, np.min_scalar_type(max(above, 1)))
    if not level:
        out += 1
        return out
    reached = {1: np.ones(n, bool)}
    for node in range(1, 2 * above):
        if node in reached and feature[node] >= 0:
            here, beyond = reached.pop(node), planes[feature[node]] > int(split[node])  # a plain number does not widen the comparison
            if node < above:
                reached[2 * node], reached[2 * node + 1] = here & ~beyond, here & beyond
            else:
                out += (here & (beyond if right[node] else ~beyond)) * out.dtype.type(node - above + 1)
    return out


def _level_histograms(spark: SparkSession, models: TreeModels, level: int, trees: int, own: list[int]):
    """mapInArrow function over blocks: (slot, part, histogram) of the nodes at ``level``, of two siblings that of the one with fewer rows.

    A slot is group index x 2^(level - 1) + place of the parent in its level (at level 0 the group), a part the task.
    Sums are made by combinations of bins that occur together, and handed out to the features after: by pairs of own
    features, and by contexts, which are few.
    """
    widths = [len(e) + 1 for e in models.edges]
    n_features, n_bins, forest = len(widths), max(widths, default=1), max(trees, 1)
    others = [i for i in range(n_features) if i not in own]
    wide, slots = n_bins > 256, max(1, 1 << level >> 1)
    row_bytes = 2 * n_features + trees + 8 * len(own) + 64
    held_bytes = 16 * forest * slots * n_features * n_bins
    out = pa.schema([("slot", pa.int64()), ("part", pa.int64()), ("histogram", pa.binary())])
    sent = spark.sparkContext.broadcast((models.feature, models.bin, models.right_is_less()))

    def count(group, blocks, total):
        """Add the blocks' rows to the group's histograms by tree, slot, sum, feature and bin."""
        feature, split, right = sent.value
        bins, copies, y, table, number = _unpacked(blocks, len(own), len(others), trees, wide)
        n = len(y)
        planes = np.empty((n_features, n), bins.dtype)
        planes[own] = bins
        for j, f in enumerate(others):
            planes[f] = table[:, j][number]
        joint = []
        for some in _joint([widths[f] for f in own], min(JOINT_CELLS // slots, max(1, n >> level))):
            code, some = np.zeros(n, np.int64), [own[i] for i in some]
            for f in some:
                code = code * widths[f] + planes[f]
            joint.append((some, code))
        sets = [(some, combination[number], cells) for some, combination, cells in _context_sets(table, others, widths, max(CONTEXT_CELLS, n >> level + 2))]
        counted = [(code, math.prod(widths[f] for f in some)) for some, code in joint] + [(code, len(cells)) for _, code, cells in sets]
        waiting = []

        def fold():
            for i, (some, _, cells) in enumerate(sets):
                sums = np.stack([x[i] for _, x in waiting]).reshape(len(waiting) * 2 * slots, len(cells))
                sums, at = _folded(sums, cells, [widths[f] for f in some]).reshape(len(waiting), 2, slots, -1), 0
                for f in some:
                    for (t, _), x in zip(waiting, sums):
                        total[t, :, :, f, :widths[f]] += x[:, :, at:at + widths[f]].transpose(1, 0, 2)
                    at += widths[f]
            waiting.clear()

        at_once = max(1, FOLD_BYTES // (16 * slots * max((len(cells) for _, _, cells in sets), default=1)))
        for t in range(forest):
            tree = group * forest + t
            if level and not (feature[tree, slots:2 * slots] >= 0).any():
                continue
            sums = [np.zeros(slots * size, complex) for _, size in counted]
            for at in range(0, n, PIECE_ROWS):
                piece = slice(at, at + PIECE_ROWS)
                place = _places(planes[:, piece], feature[tree], split[tree], right[tree], level)
                rows = np.flatnonzero((place != 0) & (copies[t, piece] != 0)) if trees else np.flatnonzero(place != 0)
                if not len(rows):
                    continue
                # the sums of copies and of labels are made at once, as real and imaginary parts
                weights = np.empty(len(rows), complex)
                weights.real = copies[t, piece][rows] if trees else 1
                np.multiply(weights.real, y[piece][rows], out=weights.imag)
                node = place[rows].astype(np.int64) - 1 if slots > 1 else None
                for h, (code, size) in zip(sums, counted):
                    cell = code[piece][rows]
                    if node is not None:
                        cell += node * size
                    np.add.at(h, cell, weights)
            for h, (some, _) in zip(sums, joint):
                shape = [widths[f] for f in some]
                for k, x in enumerate((h.real, h.imag)):
                    x = x.reshape(slots, *shape)
                    for i, f in enumerate(some):
                        total[t, :, k, f, :widths[f]] += x.sum(axis=tuple(j + 1 for j in range(len(some)) if j != i))
            if sets:
                waiting.append((t, [np.stack([h.real, h.imag]) for h in sums[len(joint):]]))
                if len(waiting) >= at_once:
                    fold()
        if waiting:
            fold()

    def states(group, total, part):
        for t in range(forest):
            some = np.flatnonzero(total[t, :, 0, 0].sum(axis=1))
            if len(some):
                yield pa.record_batch([pa.array((group * forest + t) * slots + some, pa.int64()), pa.array([part] * len(some), pa.int64()),
                                       pa.array([zstandard.compress(total[t, s].tobytes(), 1) for s in some], pa.binary())], schema=out)

    def run(batches):
        from pyspark import TaskContext

        part, waiting, rows, packed, held = TaskContext.get().partitionId(), {}, {}, 0, {}

        def add(group, blocks):
            if group not in held:
                while held and (len(held) + 1) * held_bytes > HELD_BYTES:
                    oldest = next(iter(held))
                    yield from states(oldest, held.pop(oldest), part)
                held[group] = np.zeros((forest, slots, 2, n_features, n_bins))
            count(group, blocks, held[group])

        for b in batches:
            for g, n, block in zip(b.column("g").to_pylist(), b.column("n").to_pylist(), b.column("block").to_pylist()):
                waiting.setdefault(g, []).append((n, block))
                rows[g] = rows.get(g, 0) + n
                packed += len(block)
                while rows.get(g, 0) * row_bytes > CHUNK_BYTES or packed > WAITING_BYTES:
                    most = max(rows, key=rows.get)
                    blocks = waiting.pop(most)
                    del rows[most]
                    packed -= sum(len(x) for _, x in blocks)
                    yield from add(most, blocks)
        for g in sorted(waiting):
            yield from add(g, waiting.pop(g))
        for g in list(held):
            yield from states(g, held.pop(g), part)

    return run, sent


def _slot_sums(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Slots and their histograms' sums, rows in the given order within a slot."""
    slots = table.column("slot").to_numpy()
    order = np.argsort(slots, kind="stable")
    data, slots = table.column("histogram").to_pylist(), slots[order]
    first = np.flatnonzero(np.concatenate([[True], slots[1:] != slots[:-1]]))
    return slots[first], np.add.reduceat(np.stack([np.frombuffer(zstandard.decompress(data[i])) for i in order]), first, axis=0)


def _merge_histograms(dealt: int):
    """Merge function of ``merge_in_stages`` over slots dealt into so many groups."""

    def merge(table: pa.Table) -> pa.Table:
        slots, h = _slot_sums(table)
        return pa.table([pa.array(slots), pa.array([zstandard.compress(x.tobytes(), 1) for x in h], pa.binary()), pa.array(slots % dealt)], ["slot", "histogram", "deal"])

    return merge


def _best_splits(n_features: int, n_bins: int, min_gain: float, level: int, counted, keep: bool):
    """applyInArrow function: sum the histograms of each slot, take them from the parent's (part -1) for the sibling's, choose each node's split.

    ``counted`` is what ``_level_histograms`` has sent; with ``keep`` the histograms of split nodes go along.
    """

    def run(table):
        table = table.sort_by("part")
        above = pc.equal(table.column("part"), -1)
        parents, states = table.filter(above), table.filter(pc.invert(above))
        slots, h = _slot_sums(states) if states.num_rows else (np.zeros(0, np.int64), np.zeros((0, 2 * n_features * n_bins)))
        if level:
            parent, whole = _slot_sums(parents)
            one = np.zeros_like(whole)
            one[np.searchsorted(parent, slots)] = h
            other = (whole - one).reshape(len(parent), 2, -1)
            other[:, 1][other[:, 0] == 0] = 0  # what rounding leaves of no rows
            half = 1 << level - 1
            right = counted.value[2][parent // half, half + parent % half]
            slots = np.stack([2 * parent + right, 2 * parent + ~right], axis=1).ravel()
            h = np.stack([one, other.reshape(whole.shape)], axis=1).reshape(len(slots), -1)
        packed, h = h, h.reshape(len(slots), 2, n_features, n_bins)
        left_n, left_s = np.cumsum(h[:, 0], axis=2), np.cumsum(h[:, 1], axis=2)
        n, s = left_n[:, :1, -1:], left_s[:, :1, -1:]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left_s**2 / left_n + (s - left_s) ** 2 / (n - left_n) - s**2 / n
        gain = np.where((left_n > 0) & (n - left_n > 0), gain, -np.inf).reshape(len(slots), -1)
        top = gain.max(axis=1)
        best = (gain >= (top - GAIN_TIE * np.abs(top))[:, None]).argmax(axis=1)
        rows, split = np.arange(len(slots)), top > min_gain
        kept = [zstandard.compress(x.tobytes(), 1) if keep and y else None for x, y in zip(packed, split)]
        return pa.table([pa.array(slots), pa.array(n.ravel()), pa.array(s.ravel()), pa.array(np.where(split, best // n_bins, -1)), pa.array(best % n_bins),
                         pa.array(np.where(split, gain[rows, best], 0.0)), pa.array(left_n.reshape(len(slots), -1)[rows, best]),
                         pa.array(left_s.reshape(len(slots), -1)[rows, best]), pa.array(kept, pa.binary())],
                        ["slot", "n", "s", "feature", "bin", "gain", "ln", "ls", "histogram"])

    return run


def fit_trees(df: DataFrame, features: list[str], label: str, depth: int = 5, n_bins: int = 32, group: str | None = "bucket", groups: int = 1,
              min_gain: float = MIN_GAIN, trees: int = 0, key: str | None = None, context: DataFrame | None = None,
              keys: tuple[str, ...] = ()) -> TreeModels:
    """Grow one regression tree per group 0..groups-1, or ``trees`` bagged ones (numbered group x trees + tree).

    Splits maximise the drop of the squared error, sL^2/nL + sR^2/nR - S^2/N;
    ties go to the lower feature, then bin. Rows are written once, as blocks of
    a group laid out so that a task meets few groups and a hot group is split
    over several tasks; every level reads that copy, which is deleted at the end.
    With no ``group`` the groups are the buckets of ``key`` (``with_bucket``), drawn inside the tasks.

    Features that are columns of ``context`` are taken from there: they are the
    same for all rows of ``keys``, and only rows with a context count (inner
    join). They are cut and binned at the grain of the keys, and a row gets its
    context as one binary of bins instead of a column per feature.
    """
    with scratch_scope(df.sparkSession), freed_shuffles(df.sparkSession):
        return _fit_trees(df, list(features), label, depth, n_bins, group, groups, min_gain, trees, key, context, list(keys))


def _fit_trees(df: DataFrame, features: list[str], label: str, depth: int, n_bins: int, group: str | None, groups: int, min_gain: float, trees: int,
               key: str | None, context: DataFrame | None, keys: list[str]) -> TreeModels:
    spark = df.sparkSession
    buckets = groups if group is None else 0
    text = key_text(key) if trees or buckets else F.lit("")
    own = [i for i, f in enumerate(features) if context is None or f not in context.columns]
    others = [i for i in range(len(features)) if i not in own]

    def doubles(numbers):
        return [F.col(features[i]).cast("double").alias(f"x{i}") for i in numbers]

    # rows without a group are left out by the tasks, so that a costly group is not computed for a filter too
    source = complete_rows(df, [label, *[features[i] for i in own]]).select(
        (F.lit(0) if buckets else F.col(group).cast("int")).alias("g"), text.alias("w"), F.col(label).cast("double").alias("y"), *doubles(own),
        *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    side, placed, joined = None, source, [f"k{i}" for i in range(len(keys))]
    if context is not None:
        side = materialize(complete_rows(context, [features[i] for i in others]).select(
            F.monotonically_increasing_id().alias("place"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], *doubles(others)))
        placed = join_small(source, side.select("place", *joined), joined).drop(*joined)
    shared, numbers = ("w", lambda c: KeyTexts(c).buckets(buckets)) if buckets else ("g", None)
    found, shares = edges_and_shares(placed, [f"x{i}" for i in own], n_bins, shared, side=side and side.drop(*joined), numbers=numbers)
    edges = [e for _, e in sorted(zip([*own, *others], found), key=lambda x: x[0])]
    tasks = max(spark.sparkContext.defaultParallelism, -(-int(shares[1].sum()) // ROWS_A_TASK))
    models = TreeModels(list(range(groups * max(trees, 1))), features, edges, depth, group or "bucket")
    if depth == 0:
        for r in (placed.withColumn("g", bucket_of("w", buckets)) if buckets else placed).where("g IS NOT NULL").groupBy("g").agg(F.count("*").alias("n"), F.sum("y").alias("s")).collect():
            models.n[r.g, 1], models.s[r.g, 1] = r.n, r.s
        return models
    if context is not None:
        codes = materialize(side.select("place", *joined).join(_context_codes(side, edges, others), "place").drop("place"))
        source = join_small(source, codes, joined).drop(*joined)
    rows = materialize(_packed(source, edges, own, trees, buckets, shares, tasks))
    # a bound of the tasks' numbers
    width, parts = max((len(e) for e in edges), default=0) + 1, max(spark.sparkContext.defaultParallelism, task_count(rows))
    node_bytes = 16 * len(features) * width * (min(parts, FAN_IN) + 4)
    a_group = max(1, min(NODES_A_GROUP, GROUP_BYTES // max(1, node_bytes)))
    schema = "slot bigint, n double, s double, feature bigint, bin bigint, gain double, ln double, ls double, histogram binary"
    parents = None
    for level in range(depth):
        slots, keep = len(models.groups) << max(level - 1, 0), level + 1 < depth
        dealt = max(1, -(-slots // a_group), min(tasks, slots))
        run, sent = _level_histograms(spark, models, level, trees, own)
        deal = F.pmod("slot", F.lit(dealt)).alias("deal")
        states = rows.mapInArrow(run, "slot bigint, part bigint, histogram binary").select("slot", "part", "histogram", deal)
        states = merge_in_stages(states, ["deal"], parts, _merge_histograms(dealt))
        if level:
            states = states.unionByName(parents.select("slot", F.lit(-1).cast("bigint").alias("part"), "histogram", deal))
        best = states.groupBy("deal").applyInArrow(_best_splits(len(features), width, min_gain, level, sent, keep), schema)
        if keep:
            best = materialize_next(best, parents)
            parents = best.where("feature >= 0")
        found = best.drop("histogram").collect()
        sent.unpersist()
        for r in found:
            g, node = r.slot >> level, (1 << level) + (r.slot & ((1 << level) - 1))
            models.n[g, node], models.s[g, node] = r.n, r.s
            if r.feature >= 0:
                models.feature[g, node], models.bin[g, node], models.gain[g, node] = r.feature, r.bin, r.gain
                models.n[g, 2 * node], models.s[g, 2 * node] = r.ln, r.ls
                models.n[g, 2 * node + 1], models.s[g, 2 * node + 1] = r.n - r.ln, r.s - r.ls
        if not any(r.feature >= 0 for r in found):
            break
    return models


def fit_local_trees(train: DataFrame, features: list[str], label: str, n_buckets: int, depth: int = 5,
                    n_bins: int = 32, key: str = "trip_id") -> TreeModels:
    return fit_trees(with_bucket(train, n_buckets, key), features, label, depth, n_bins, "bucket", n_buckets)


def score_tree_ensemble(models: TreeModels, df: DataFrame, out: str = "prediction", depth: int | None = None, weights: np.ndarray | None = None) -> DataFrame:
    """Mean over the fitted groups of each tree's value for a row, optionally cut off at ``depth``; null where a feature is missing.

    With ``weights``, one per group, their weighted sum in place of the mean.
    """
    depth = models.depth if depth is None else depth
    fitted = np.flatnonzero(models.n[:, 1] > 0)
    features, edges, n_trees = models.features, models.edges, len(fitted)
    value = models.value()[fitted] * (1 / max(n_trees, 1) if weights is None else weights[fitted, None])
    sent = df.sparkSession.sparkContext.broadcast((models.feature[fitted], models.bin[fitted], value))
    schema = StructType(list(df.schema.fields) + [StructField(out, DoubleType(), True)])

    def run(batches):
        feature, split, value = sent.value
        step = max(1, WALK_CELLS // max(1, n_trees))
        for b in batches:
            x = [b.column(b.schema.get_field_index(f)).cast(pa.float64()).to_numpy(zero_copy_only=False) for f in features]
            missing = np.zeros(b.num_rows, bool)
            for c in x:
                missing |= np.isnan(c)
            bins, total = _binned(x, edges), np.zeros(b.num_rows)
            for at in range(0, b.num_rows, step):
                some = bins[at:at + step]
                tree = np.tile(np.arange(n_trees), len(some))
                node = _walk(np.repeat(some, n_trees, axis=0), tree, feature, split, depth)
                total[at:at + step] = value[tree, node].reshape(len(some), n_trees).sum(axis=1)
            total = pa.array(total, mask=missing | (n_trees == 0))
            yield pa.RecordBatch.from_arrays([*b.columns, total], [*b.schema.names, out])

    return df.mapInArrow(run, schema)


# ---------------------------------------------------------------------------
# random forest feature votes
# ---------------------------------------------------------------------------

def forest_importances(df: DataFrame, features: list[str], label: str, n_buckets: int = 24,
                       n_trees: int = 100, depth: int = 5, n_bins: int = 32, key: str = "trip_id", context: DataFrame | None = None,
                       keys: tuple[str, ...] = ()) -> DataFrame:
    """(bucket, feature, importance, selected) of a random forest per bucket; ``context`` and ``keys`` as for ``fit_trees``.

    A tree's importances are its splits' error drops by feature, summing to 1;
    a forest's are their mean. Selected: at least the mean of the bucket's importances.
    """
    models = fit_trees(df, features, label, depth, n_bins, None, n_buckets, trees=n_trees, key=key, context=context, keys=keys)
    # arrays of trees x nodes, summed by feature, then shared out inside each tree
    drop = np.stack([np.where(models.feature == f, models.gain, 0).sum(axis=1) for f in range(len(features))], axis=1)
    share = drop / np.maximum(drop.sum(axis=1, keepdims=True), 1e-300)
    forest = share.reshape(n_buckets, n_trees, len(features)).mean(axis=1)
    rows = [(b, features[f], float(forest[b, f]), bool(forest[b, f] >= forest[b].mean())) for b in range(n_buckets) for f in range(len(features))
            if forest[b].sum() > 0]
    return local_table(df.sparkSession, rows, "bucket int, feature string, importance double, selected boolean")


def select_features(df: DataFrame, features: list[str], label: str, n_buckets: int = 24,
                    n_trees: int = 100, depth: int = 5, n_bins: int = 32, key: str = "trip_id", context: DataFrame | None = None,
                    keys: tuple[str, ...] = ()) -> DataFrame:
    """Per bucket, the features whose forest importance is at least the mean: (bucket, feature, importance)."""
    return forest_importances(df, features, label, n_buckets, n_trees, depth, n_bins, key, context, keys).where("selected").drop("selected")


def feature_votes(selected: DataFrame, domain: list[str]) -> DataFrame:
    """Votes per feature over buckets; features never selected get 0."""
    spark = selected.sparkSession
    dom = local_table(spark, [(f,) for f in domain], "feature string")
    cnt = selected.groupBy("feature").agg(F.count("*").alias("votes"))
    return dom.join(cnt, "feature", "left").fillna(0, subset=["votes"])
