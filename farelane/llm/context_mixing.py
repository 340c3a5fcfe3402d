"""Language-model scores by logistic context mixing (operator 2).

The model predicts a text's lower-cased words and the end, bit by bit. Several
predictors look at the bits read so far under hashed contexts (the last one to
five bytes of a word, its start marked, some with the text's class); each turns the two counts in its slot
into a probability. Their logits are combined by weights that a gate picks
(how much the two longest contexts have seen), learned online: weights follow
the error of each small batch of training words, which are predicted with
their own occurrence taken out of the counts. The mix is then refined
adaptively inside each text: a Bayesian average, updated with every token,
over ways to blend the mixed spelling probability, the word's frequency in the
corpus and in the texts of the class, its frequency in the text so far, and
its share of what follows the word before it (or a text's start) in the
training texts, without the text itself.
For a held-out text the result is a proper probability of the whole token
sequence, with the class, one of a few clusters by byte frequencies (languages,
mostly), paid for first; ``bits_per_byte`` is its total cost. A training text
is scored by the same model, which has learned from it: only its own pairs of
words are taken out, its words' frequencies are not.

How it runs: texts become chunks of word numbers with a dictionary for each
chunk, so a word crosses the shuffle once for a chunk, not once for an
occurrence. Counts of words are summed over the whole corpus; the predictors
count each distinct word, weighted; spelling probabilities are computed once
for each distinct word and joined back to the chunks' dictionaries. Pairs of
words are counted over the whole corpus too, under 63-bit hashes made of their
words' 48-bit ones: chunks send
their distinct pairs by ranges of the hash and get the totals back. The class
centres are fitted to the byte profiles of all training texts, which are
written once; a pass over them sends sums of a fixed size. Predictors' tables
and centres have a fixed size, whatever the corpus; only they are broadcast.

Defined results: null and empty texts are the end token alone; a null id counts
as the empty text in the fold; repeated rows are separate documents; without
training texts the counts are zero and the model is its prior; an empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelane.llm.common import col, give_back, keep, pieces_for, table, whole_text
from farelane.llm.word_tokens import large
from farelane.plans.staged_merge import merge_in_stages, task_count
from farelane.session import scratch_scope

FOLDS, HELD_OUT = 5, 1
CHUNK_BYTES = 24 << 20
WORDS_AT_ONCE = 100_000
#: Words that weights are learned from in one task, before they are averaged.
WORDS_A_LESSON = 300_000
TOKENS_AT_ONCE = 400_000
#: Context length in bytes, whether the class belongs to it, and table size in bits of each predictor.
PREDICTORS = ((1, True, 18), (2, True, 20), (3, False, 20), (3, True, 20), (5, False, 20))
CLASSES, SEED = 8, 5
#: Passes that move the centres, at most, and the squared distance of profiles that count as one.
LLOYD_PASSES, SAME_PROFILE = 20, 1e-6
#: Texts whose profiles make a block.
TEXTS_A_BLOCK = 4096
#: A task holds texts back until they make a chunk and this part of a second one, so that no small rest is left.
CHUNK_SLACK = 1.25
#: Chunk and entry cross the shuffle as one number: the task's bits, then the chunk's, then the entry's. More of any is an error.
TASK_BITS, CHUNK_BITS, ENTRY_BITS = 24, 13, 26
#: Bytes of a word's hash, from which the names of its pairs are made, and the level at which payloads are compressed.
HASH_BYTES, PAYLOAD_LEVEL = 6, 6
GATES, RATE, BATCH = 16, 0.02, 16_384
# Symbols that no word holds. A word ends with SPACE; END alone ends a text.
SPACE, END = 0x20, "\n"
#: Pairs of words, over all chunks, that one task adds up.
PAIRS_A_RANGE = 2_000_000
#: Blends of (spelling, corpus, class, text so far, word before) that a text's average starts from.
BLENDS = tuple((s, 0.2 * (1 - s) * (1 - t) * (1 - r), 0.8 * (1 - s) * (1 - t) * (1 - r), (1 - s) * t, (1 - s) * (1 - t) * r)
               for s in (0.02, 0.1, 0.25, 0.5) for t in (0.02, 0.1, 0.3, 0.7) for r in (0.1, 0.6))


# --- classes of texts -------------------------------------------------------

def byte_profiles(texts: pa.Array) -> np.ndarray:
    """Square roots of the byte frequencies of each text (lower case); zeros for an empty one."""
    texts = pc.ascii_lower(large(texts))
    ends = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy())])
    data = np.frombuffer(b"".join([x.as_buffer() for x in texts]), np.uint8)
    out = np.zeros((len(texts), 256))
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + (1 << 20), "right")) - 1)
        text = np.repeat(np.arange(last - first), np.diff(ends[first:last + 1]))
        out[first:last] = np.bincount(text * 256 + data[ends[first]:ends[last]], minlength=(last - first) * 256).reshape(-1, 256)
        first = last
    return np.sqrt(out / np.maximum(out.sum(axis=1, keepdims=True), 1))


def nearest(profiles: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1) - 2 * profiles @ centres.T).argmin(axis=1)


def _profile_blocks(docs: DataFrame) -> DataFrame:
    """(n, used, hashes, profiles): the byte profiles of all training texts in blocks, of the bytes that a block uses; ``docs`` has doc_id, held_out, text."""
    rows = docs.where(~F.col("held_out")).select(F.xxhash64("doc_id", "text").alias("h"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, TEXTS_A_BLOCK):
                some = b.slice(at, TEXTS_A_BLOCK)
                profiles = byte_profiles(some.column(1)).astype("<f4")
                used = np.flatnonzero(profiles.any(axis=0))
                yield pa.record_batch([pa.array([some.num_rows]), pa.array([used.astype(np.uint8).tobytes()], pa.binary()),
                                       pa.array([some.column(0).to_numpy().astype("<i8").tobytes()]), pa.array([np.ascontiguousarray(profiles[:, used]).tobytes()])],
                                      ["n", "used", "hashes", "profiles"])

    return rows.mapInArrow(run, "n bigint, used binary, hashes binary, profiles binary")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hashes, used bytes, profiles of those) of each block."""
    for b in batches:
        for n, used, hashes, profiles in zip(*(c.to_pylist() for c in b.columns), strict=True):
            yield np.frombuffer(hashes, "<i8"), np.frombuffer(used, np.uint8).astype(np.int64), np.frombuffer(profiles, "<f4").reshape(n, -1)


def _distances(used: np.ndarray, profiles: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of texts and centres, less each text's own square."""
    return (centres * centres).sum(axis=1) - 2 * profiles @ centres[:, used].T.astype(np.float32)


def _seed(blocks: DataFrame, centres: np.ndarray) -> np.ndarray | None:
    """A text's profile, drawn over all texts by squared distance to the nearest centre (evenly without one); None if there is no other profile.

    The text with the least -ln(u) / distance is drawn so; u is a hash of its
    id and content and of the round, so repeats of a row and reruns draw alike.
    """
    turn = np.uint64((len(centres) + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for hashes, used, profiles in _blocks(batches):
            u = hashes.view("<u8") ^ turn
            for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
                u = (u ^ u >> np.uint64(shift)) * np.uint64(factor)
            u = ((u ^ u >> np.uint64(33)) >> np.uint64(11)).astype(float) / 2**53
            far = np.ones(len(u)) if not len(centres) else _distances(used, profiles, centres).min(axis=1) + (profiles * profiles).sum(axis=1)
            with np.errstate(divide="ignore"):
                key = np.where(far > SAME_PROFILE, -np.log1p(-u) / np.maximum(far, SAME_PROFILE), np.inf)
            i = int(key.argmin())
            if np.isfinite(key[i]):
                whole = np.zeros(256)
                whole[used] = profiles[i]
                best = min(filter(None, (best, (float(key[i]), whole.tobytes()))))
        if best:
            yield pa.record_batch([pa.array([best[0]]), pa.array([best[1]])], ["key", "profile"])

    found = blocks.mapInArrow(run, "key double, profile binary").agg(F.min(F.struct("key", "profile")).alias("first")).first().first
    return None if found is None else np.frombuffer(bytes(found.profile))


def _moved(blocks: DataFrame, centres: np.ndarray, parts: int) -> np.ndarray:
    """The mean profile of the texts nearest to each centre; a centre without any stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centres), 257))
        for _, used, profiles in _blocks(batches):
            of = _distances(used, profiles, centres).argmin(axis=1)
            member = np.zeros((len(centres), len(of)), np.float32)
            member[of, np.arange(len(of))] = 1
            total[:, used] += member @ profiles
            total[:, 256] += np.bincount(of, minlength=len(centres))
        yield pa.record_batch([pa.array([0]), pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.tobytes()])], ["k", "part", "total"])

    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py()) for x in t.column("total"))
        return pa.table([t.column("k").slice(0, 1), pa.array([total.tobytes()], pa.binary())], ["k", "total"])

    states = merge_in_stages(blocks.mapInArrow(run, "k bigint, part bigint, total binary"), ["k"], parts, add).collect()
    total = sum((np.frombuffer(bytes(r.total)) for r in sorted(states, key=lambda r: r.part)), np.zeros(257 * len(centres))).reshape(-1, 257)
    return np.where(total[:, 256:] > 0, total[:, :256] / np.maximum(total[:, 256:], 1), centres)


def _fit_few(docs: DataFrame, classes: int, sample_docs: int) -> np.ndarray:
    """``fit_classes`` on about ``sample_docs`` training texts."""
    one_in = pieces_for(docs.count(), sample_docs)
    h = F.xxhash64("doc_id", "text")  # by id and content, and never more than twice the bound, whatever is repeated
    some = docs.select("held_out", "text", h.alias("h")).where(~F.col("held_out") & (F.pmod("h", F.lit(one_in)) == 0)).select("h", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array([x.tobytes() for x in byte_profiles(b.column(1))], pa.binary())], ["h", "profile"])

    x = [np.frombuffer(bytes(r.profile)) for r in some.mapInArrow(run, "h bigint, profile binary").distinct().orderBy("h").limit(2 * sample_docs).collect()]
    x = np.unique(np.stack(x), axis=0) if x else np.zeros((1, 256))
    rng = np.random.default_rng(SEED)
    centres = x[rng.integers(len(x))][None]
    while len(centres) < min(classes, len(x)):
        d = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2).min(axis=1)
        centres = np.vstack([centres, x[rng.choice(len(x), p=d / d.sum())]])
    for _ in range(20):
        of = nearest(x, centres)
        centres = np.stack([x[of == k].mean(axis=0) if (of == k).any() else centres[k] for k in range(len(centres))])
    return centres


def fit_classes(docs: DataFrame, classes: int = CLASSES, sample_docs: int | None = None) -> np.ndarray:
    """Cluster centres (k-means) of the byte profiles of all training texts; ``docs`` has doc_id, held_out, text.

    For trials a caller may ask for about ``sample_docs`` texts instead; scores never do.
    """
    if sample_docs is not None:
        return _fit_few(docs, classes, sample_docs)
    with scratch_scope(docs.sparkSession):
        blocks = keep(_profile_blocks(docs))
        centres, parts = np.zeros((0, 256)), task_count(blocks)
        while len(centres) < classes and (seed := _seed(blocks, centres)) is not None:
            centres = np.vstack([centres, seed])
        if not len(centres):
            return np.zeros((1, 256))
        for _ in range(LLOYD_PASSES):
            before, centres = centres, _moved(blocks, centres, parts)
            if np.array_equal(before, centres):
                break
        return centres


# --- chunks -----------------------------------------------------------------

def _chunk_rows(ids: pa.Array, held: pa.Array, texts: pa.Array, chunk: int, centres: np.ndarray):
    """Rows of one chunk: its dictionary of (class, word) with training counts, and all its texts as entry numbers in one payload."""
    texts = large(texts)
    n_bytes = pc.binary_length(texts).to_numpy()
    cls = nearest(byte_profiles(texts), centres)
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat = split.flatten()
    real = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    coded = flat.filter(pa.array(real)).dictionary_encode()
    starts = np.concatenate([[0], np.cumsum(real)])[split.offsets.to_numpy() - split.offsets[0].as_py()]
    del split, flat, texts, real
    pa.default_memory_pool().release_unused()
    if len(coded.dictionary) + 1 >> ENTRY_BITS:
        raise ValueError(f"{len(coded.dictionary)} distinct words in one chunk: use smaller chunks")
    # the end token closes each text
    words = np.insert(coded.indices.to_numpy(), starts[1:], len(coded.dictionary))
    n_tokens = np.diff(starts) + 1
    words = words.astype(np.int32) * np.int32(len(centres)) + np.repeat(cls.astype(np.int32), n_tokens)
    present = np.zeros((len(coded.dictionary) + 1) * len(centres), bool)
    present[words] = True
    entries = np.flatnonzero(present)
    words = (np.cumsum(present, dtype=np.int32) - 1)[words]
    train = ~held.to_numpy(zero_copy_only=False)
    counts = np.bincount(words[np.repeat(train, n_tokens)], minlength=len(entries))
    # frequent words get small numbers, which the planes of bytes compress well
    order = np.argsort(-np.bincount(words, minlength=len(counts)), kind="stable")
    number = np.empty(len(order), np.uint32)
    number[order] = np.arange(len(order), dtype=np.uint32)
    planes = np.ascontiguousarray(number[words].astype("<u4").view(np.uint8).reshape(-1, 4).T)
    batch = pa.record_batch([ids, held, pa.array(n_tokens, pa.int64()), pa.array(n_bytes, pa.int64()), pa.array(cls)], ["doc_id", "held_out", "n_tokens", "n_bytes", "cls"])
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_batch(batch)
    head = sink.getvalue()
    vocabulary = pa.concat_arrays([coded.dictionary.cast(pa.string()), pa.array([END])])
    hashes = np.array([xxhash.xxh64_intdigest(w, seed=SEED) for w in vocabulary.cast(pa.binary()).to_pylist()], np.uint64)
    of_word = entries[order] // len(centres)
    hashes = np.ascontiguousarray(hashes[of_word].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES])
    payload = zstandard.compress(len(head).to_bytes(8, "little") + len(order).to_bytes(8, "little") + head + hashes.tobytes() + planes.tobytes(), PAYLOAD_LEVEL)
    vocabulary = vocabulary.take(pa.array(of_word))
    marks = pa.array([chr(ord("0") + k) for k in range(len(centres))]).take(pa.array(entries[order] % len(centres)))
    m = len(order)
    schema = pa.schema([("chunk", pa.int64()), ("k", pa.int32()), ("entry", pa.string()), ("n", pa.int64()), ("payload", pa.binary())])
    yield pa.record_batch([pa.array(np.full(m, chunk)), pa.array(np.arange(m, dtype=np.int32)), pc.binary_join_element_wise(marks, vocabulary, ""), pa.array(counts[order]), pa.nulls(m, pa.binary())], schema=schema)
    yield pa.record_batch([pa.array([chunk]), pa.nulls(1, pa.int32()), pa.nulls(1, pa.string()), pa.array([len(words)]), pa.array([payload])], schema=schema)
    pa.default_memory_pool().release_unused()


def _read_payload(payload: bytes) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
    """(texts, entry number of each token, hash of each entry's word)."""
    data = zstandard.decompress(payload)
    n, m = int.from_bytes(data[:8], "little"), int.from_bytes(data[8:16], "little")
    batch = pa.ipc.open_stream(data[16:16 + n]).read_next_batch()
    hashes = np.zeros((m, 8), np.uint8)
    hashes[:, :HASH_BYTES] = np.frombuffer(data, np.uint8, HASH_BYTES * m, offset=16 + n).reshape(m, HASH_BYTES)
    planes = np.frombuffer(data, np.uint8, offset=16 + n + HASH_BYTES * m).reshape(4, -1)
    return batch, np.ascontiguousarray(planes.T).view("<u4").ravel(), hashes.view("<u8").ravel()


def folded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, text)."""
    fold = F.crc32(F.coalesce(col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS
    return docs.select(col(id_col).cast("bigint").alias("doc_id"), (fold == HELD_OUT).alias("held_out"), whole_text(text_col).alias("text"))


def chunks(docs: DataFrame, centres: np.ndarray, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(chunk, k, entry, n, payload): dictionary rows and one payload row of each chunk of ``folded`` rows.

    An entry is the class's digit and the word, k its number in the chunk. In
    a payload's row n is the number of tokens.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        size = 0

        def cut(all_: bool):
            """Whole chunks of what is held; with ``all_`` the rest is one too."""
            nonlocal held, size, made
            t = pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=None)[0]
            held = []
            sizes = np.cumsum(pc.fill_null(pc.binary_length(t.column(2)), 0).to_numpy().astype(np.int64))
            first = 0
            while first < t.num_rows:
                base = sizes[first - 1] if first else 0
                if sizes[-1] - base <= chunk_bytes * CHUNK_SLACK:
                    if not all_:
                        break
                    last = t.num_rows
                else:
                    last = max(first + 1, int(np.searchsorted(sizes, base + chunk_bytes, "right")))
                if made >> CHUNK_BITS or task >> TASK_BITS:
                    raise ValueError(f"task {task} makes chunk {made}: use more, smaller partitions or larger chunks")
                part = t.slice(first, last - first)
                yield from _chunk_rows(part.column(0), part.column(1), part.column(2), task << CHUNK_BITS | made, centres)
                made, first = made + 1, last
            if first < t.num_rows:
                held = [pa.Table.from_batches([t.slice(first)]).take(pa.array(range(t.num_rows - first))).combine_chunks().to_batches()[0]]  # a copy: the rest is let go
            size = sum(pc.sum(pc.binary_length(h.column(2))).as_py() or 0 for h in held)

        for b in batches:
            if not b.num_rows:
                continue
            held.append(b.set_column(2, "text", large(b.column(2))))
            size += pc.sum(pc.binary_length(b.column(2))).as_py() or 0
            if size > chunk_bytes * CHUNK_SLACK:
                yield from cut(False)
        if held:
            yield from cut(True)
        give_back()

    return docs.mapInArrow(run, "chunk bigint, k int, entry string, n bigint, payload binary")


# --- pairs of words ---------------------------------------------------------

def _pair_keys(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """63 bits, and a last one that is 0, for each token and the one before it; the end of a text comes before the next one, and before the first."""
    own = hashes[words]
    key = np.roll(own, 1)
    key *= np.uint64(0x9E3779B97F4A7C15)
    key ^= key >> np.uint64(29)
    key += own
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        key ^= key >> np.uint64(shift)
        key *= np.uint64(factor)
    return (key ^ key >> np.uint64(33)) & ~np.uint64(1)


def _pack(*columns: np.ndarray) -> bytes:
    """64-bit numbers as compressed planes of bytes."""
    return zstandard.compress(b"".join(np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns), 1)


def _unpack(data: bytes, columns: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(columns, 8, -1)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u8")[:, :, 0]


def pair_counts(payloads: DataFrame, tokens: int) -> DataFrame:
    """(chunk, part, payload): how often the pairs of each chunk occur in all training texts.

    Each chunk sends each range of keys what it has of it, as one row; a range
    adds up and answers every chunk in the order of its keys.
    """
    ranges = pieces_for(tokens, PAIRS_A_RANGE)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, payload in zip(b.column(0), b.column(1), strict=True):
                batch, words, hashes = _read_payload(payload.as_py())
                keys = _pair_keys(words, hashes)
                # the last bit, which no key has, marks training texts while keys are sorted
                keys |= np.repeat(~batch.column("held_out").to_numpy(zero_copy_only=False), batch.column("n_tokens").to_numpy())
                keys.sort()
                learned = keys & np.uint64(1)
                keys ^= learned
                first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
                keys, counts = keys[first], np.add.reduceat(learned, first)
                part = ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
                cuts = np.searchsorted(part, np.arange(ranges + 1, dtype=np.uint64))
                for p in np.flatnonzero(np.diff(cuts)):
                    i = slice(cuts[p], cuts[p + 1])
                    yield pa.record_batch([pa.array([chunk.as_py()]), pa.array([p], pa.int32()), pa.array([_pack(np.diff(keys[i], prepend=np.uint64(0)), counts[i])])], ["chunk", "part", "payload"])
                del batch, words, hashes, keys, learned, first, counts, part
                give_back()

    def add(key, t):
        chunks_, sizes, keys, counts = t.column("chunk"), [], [], []
        for data in t.column("payload"):
            deltas, n = _unpack(data.as_py(), 2)
            sizes.append(len(n))
            keys.append(np.cumsum(deltas, dtype=np.uint64))
            counts.append(n)
        _, of = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(of, np.concatenate(counts).astype(float))
        ends = np.cumsum(sizes)
        answers = [_pack(total[of[end - n:end]]) for n, end in zip(sizes, ends, strict=True)]
        return pa.table([chunks_, t.column("part"), pa.array(answers, pa.binary())], ["chunk", "part", "payload"])

    schema = "chunk bigint, part int, payload binary"
    return payloads.mapInArrow(send, schema).groupBy("part").applyInArrow(add, schema)


# --- the bit predictors -----------------------------------------------------

@dataclass
class Symbols:
    """Bytes of words in a row: each one's hashed contexts and its word's number."""

    value: np.ndarray
    contexts: list[np.ndarray]
    word: np.ndarray

    def nodes(self, bit: int) -> np.ndarray:
        """The bits of a byte before this one, with a leading one."""
        return (np.uint32(1 << bit) | (self.value >> np.uint32(8 - bit))) * np.uint32(0x9E3779B1)

    def slots(self, predictor: int, nodes: np.ndarray) -> np.ndarray:
        h = (self.contexts[predictor] ^ nodes) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0xC2B2AE35)
        return (h >> np.uint32(32 - PREDICTORS[predictor][2])).astype(np.int64)

    def bit(self, bit: int) -> np.ndarray:
        return (self.value >> np.uint32(7 - bit)) & np.uint32(1) == 1


def symbols(entries: pa.Array) -> Symbols:
    # a word's bytes lie between its class's digit and the next entry's, whose place its end takes
    lengths = pc.binary_length(entries).to_numpy().astype(np.int64)
    data = np.frombuffer(pc.binary_join(pa.ListArray.from_arrays([0, len(entries)], entries), "")[0].as_buffer(), np.uint8).astype(np.uint32)
    first = np.cumsum(lengths) - lengths
    cls = data[first] - np.uint32(ord("0"))
    alone = np.flatnonzero((lengths == 2) & (data[np.minimum(first + 1, len(data) - 1)] == ord(END)))
    value = np.append(data[1:], np.uint32(SPACE))
    value[first[1:] - 1] = SPACE
    value = np.delete(value, first[alone] + 1)
    lengths[alone] = 1
    word = np.repeat(np.arange(len(entries), dtype=np.int32), lengths)
    place = (np.arange(len(value)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.uint32)
    deepest = max(length for length, _, _ in PREDICTORS)
    before = []
    for back in range(1, deepest + 1):
        x = np.zeros_like(value)
        x[back:] = value[:-back] + np.uint32(1)
        x[place < back] = 0
        before.append(x)
    contexts = []
    for length, classed, _ in PREDICTORS:
        h = np.minimum(place, np.uint32(length))  # the start of the word is part of the context
        if classed:
            h = h + np.uint32(16) * (cls[word] + np.uint32(1))
        for x in before[:length]:
            h = (h + x) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(13)
        contexts.append(h * np.uint32(0xC2B2AE35))
    return Symbols(value, contexts, word)


def _batches_of_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    kept, n = [], 0
    for b in batches:
        kept.append(b)
        n += b.num_rows
        if n >= WORDS_AT_ONCE:
            t = pa.Table.from_batches(kept)
            kept, n = [], 0
            for at in range(0, len(t), WORDS_AT_ONCE):
                s = t.slice(at, WORDS_AT_ONCE)
                yield s.column("entry").combine_chunks(), s.column("n").to_numpy()
            pa.default_memory_pool().release_unused()
    if n:
        t = pa.Table.from_batches(kept)
        yield t.column("entry").combine_chunks(), t.column("n").to_numpy()


TABLE_BLOCK = 1 << 16


def count_bits(tables: list[np.ndarray], s: Symbols, n: np.ndarray) -> None:
    """Add each bit of words that occur ``n`` times to ``tables``; in place and a bit at a time, as all bits at once would take some 300 MB."""
    weight = n[s.word].astype(float)
    for bit in range(8):
        nodes, one = s.nodes(bit), s.bit(bit)
        for p, t in enumerate(tables):
            slots = s.slots(p, nodes)
            slots += one * t.shape[1]
            np.add.at(t.reshape(-1), slots, weight)


def predictor_tables(words: DataFrame) -> list[np.ndarray]:
    """(2, slots) counts of zero and one bits of each predictor, from (entry, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros((2, 1 << bits)) for _, _, bits in PREDICTORS]
        any_, part = False, TaskContext.get().partitionId()
        for w, c in _batches_of_entries(batches):
            any_ = True
            count_bits(tables, symbols(w), c)
        if any_:
            for p, t in enumerate(tables):
                for at in range(0, t.shape[1], TABLE_BLOCK):
                    block = t[:, at:at + TABLE_BLOCK]
                    yield pa.record_batch([pa.array([p], pa.int32()), pa.array([at], pa.int32()), pa.array([part], pa.int64()),
                                           pa.array([zstandard.compress(block.tobytes(), 1)])], ["p", "at", "part", "counts"])
        del tables
        give_back()

    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zstandard.decompress(x.as_py())) for x in t.column("counts"))
        return pa.table([t.column("p").slice(0, 1), t.column("at").slice(0, 1), pa.array([zstandard.compress(total.tobytes(), 1)], pa.binary())], ["p", "at", "counts"])

    # no group holds more than a fan-in's blocks, however many tasks there are
    blocks = merge_in_stages(words.mapInArrow(run, "p int, at int, part bigint, counts binary"), ["p", "at"], task_count(words), add)
    last = lambda t: add(t.sort_by("part"))
    out = [np.zeros((2, 1 << bits)) for _, _, bits in PREDICTORS]
    for r in blocks.groupBy("p", "at").applyInArrow(last, "p int, at int, counts binary").toArrow().to_pylist():
        block = np.frombuffer(zstandard.decompress(r["counts"])).reshape(2, -1)
        out[r["p"]][:, r["at"]:r["at"] + block.shape[1]] = block
    return [t.astype(np.float32) for t in out]


def _logits(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.log(ones + np.float32(0.02)) - np.log(zeros + np.float32(0.02))


def _side_by_side(table: np.ndarray) -> np.ndarray:
    """A slot's two counts as one value of 8 bytes, which is looked up once."""
    return np.ascontiguousarray(table.T, np.float32).view(np.float64).ravel()


def _steps(total: np.ndarray) -> np.ndarray:
    """How much a context has seen, in four steps."""
    return (total >= 1).astype(np.int8) + (total >= 8) + (total >= 64)


def _inputs(s: Symbols, bit: int, tables: list[np.ndarray], one: np.ndarray | None, ready: list | None) -> tuple[np.ndarray, np.ndarray]:
    """(logits of each predictor and a bias, by row; gate) of one bit of every symbol.

    With ``one``, the bit's own occurrence is taken out of the counts (``_side_by_side``);
    without, ``ready`` holds each slot's logit and step.
    """
    nodes = s.nodes(bit)
    x = np.ones((len(PREDICTORS) + 1, len(nodes)), np.float32)
    gate = np.zeros(len(nodes), np.int64)
    for p, t in enumerate(tables):
        slot = s.slots(p, nodes)
        gates = p >= len(PREDICTORS) - 2
        if one is None:
            x[p] = ready[p][0][slot]
            if gates:
                gate = gate * 4 + ready[p][1][slot]
        else:
            both = t.take(slot).view(np.float32)
            zeros, ones = np.maximum(both[0::2] - ~one, 0), np.maximum(both[1::2] - one, 0)
            x[p] = _logits(zeros, ones)
            if gates:
                gate = gate * 4 + _steps(zeros + ones)
    return x, gate


def _start_weights() -> np.ndarray:
    w = np.full((GATES, len(PREDICTORS) + 1), 1 / len(PREDICTORS))
    w[:, -1] = 0
    return w


def learn_weights(words: DataFrame, sent) -> np.ndarray:
    """Gated weights: learned online over the training words of each task, then averaged by the tokens each has seen at each gate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, seen = _start_weights(), np.zeros(GATES)
        tables = [_side_by_side(t) for t in sent.value]
        for some, c in _batches_of_entries(batches):
            s = symbols(some)
            weight = c[s.word].astype(float)  # a step is their mean over a batch
            for bit in range(8):
                one = s.bit(bit)
                x, gate = _inputs(s, bit, tables, one, None)
                for at in range(0, len(one), BATCH):
                    i = slice(at, at + BATCH)
                    g = gate[i]
                    z = sum(x[k, i] * w[:, k].take(g) for k in range(len(x)))
                    error = (one[i] - 1 / (1 + np.exp(-np.clip(z, -30, 30)))) * weight[i]
                    mass = np.bincount(g, weight[i], GATES)
                    step = np.stack([np.bincount(g, error * x[k, i], GATES) for k in range(len(x))], axis=1)
                    w += RATE * step / np.maximum(mass, 1)[:, None]
                    seen += mass
        yield pa.record_batch([pa.array([seen.tobytes()]), pa.array([w.tobytes()])], ["seen", "w"])
        del tables
        give_back()

    rows = words.mapInArrow(run, "seen binary, w binary").collect()
    rows = sorted((bytes(r.seen), bytes(r.w)) for r in rows)  # one order, so one sum
    total, mean = np.zeros(GATES), np.zeros((GATES, len(PREDICTORS) + 1))
    for seen, w in rows:
        seen, w = np.frombuffer(seen), np.frombuffer(w).reshape(GATES, -1)
        total += seen
        mean += seen[:, None] * w
    return np.where(total[:, None] > 0, mean / np.maximum(total, 1e-9)[:, None], _start_weights())


def spelling_scores(words: DataFrame, sent, weights: np.ndarray) -> DataFrame:
    """(entry, n, spelled): the natural log of the mixed probability of each word's bytes and its end, in texts of a class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = sent.value
        ready = [(_logits(*t), _steps(t.sum(axis=0))) for t in tables]
        for some, c in _batches_of_entries(batches):
            s = symbols(some)
            cost = np.zeros(len(s.value))
            for bit in range(8):
                x, gate = _inputs(s, bit, tables, None, ready)
                z = sum(x[k] * weights[:, k].take(gate) for k in range(len(x)))
                cost += np.logaddexp(0, np.where(s.bit(bit), -z, z))
            spelled = -np.bincount(s.word, cost, len(some))
            yield pa.record_batch([some, pa.array(c), pa.array(spelled)], ["entry", "n", "spelled"])
        del ready
        give_back()

    return words.mapInArrow(run, "entry string, n bigint, spelled double")


# --- texts ------------------------------------------------------------------

def _score_texts(batch: pa.RecordBatch, words: np.ndarray, keys: np.ndarray, pairs: np.ndarray, c: np.ndarray, in_class: np.ndarray, spelled: np.ndarray,
                 n_train: int, v_train: int, classes: int):
    """Columns of the texts of one chunk; ``pairs`` has the training count of each distinct one of ``keys``, in order."""
    n_tokens = batch.column("n_tokens").to_numpy()
    train = ~batch.column("held_out").to_numpy(zero_copy_only=False)
    # other texts' training count of each token's pair: equal keys lie together, and in them those of one text
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    n_keys = len(keys)
    del keys
    order = order.astype(np.int32) if n_keys < 2**31 else order
    text = np.repeat(np.arange(len(n_tokens), dtype=np.int32), n_tokens)
    of_text = text[order]
    runs = np.flatnonzero(new | np.concatenate([[True], np.diff(of_text) != 0]))
    lengths = np.diff(runs, append=n_keys)
    found = np.empty(n_keys, np.int64)
    found[order] = pairs[np.cumsum(new) - 1] - np.repeat(lengths * train[of_text[runs]], lengths)
    del order, new, of_text, runs, lengths, text
    ends = np.cumsum(n_tokens)
    base_of = np.log10((c + 0.5) / (n_train + 0.5 * (v_train + 1)))
    often = c / max(n_train, 1)  # in_class is such a share already
    spell = np.exp(spelled)
    known, base, score = np.zeros(len(n_tokens), np.int64), np.zeros(len(n_tokens)), np.zeros(len(n_tokens))
    first = 0
    while first < len(n_tokens):
        start = ends[first] - n_tokens[first]
        last = max(first + 1, int(np.searchsorted(ends, start + TOKENS_AT_ONCE, "right")))
        w = words[start:ends[last - 1]].astype(np.int64)
        cuts = ends[first:last] - n_tokens[first:last] - start
        text = np.repeat(np.arange(last - first), n_tokens[first:last])
        known[first:last] = np.add.reduceat((c[w] > 0).astype(np.int64), cuts)
        base[first:last] = np.add.reduceat(base_of[w], cuts)
        # how often each token's word came before in its text
        key = text * len(c) + w
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
        at = np.arange(len(w))
        before, in_text = np.empty(len(w), np.int64), np.empty(len(w), np.int64)
        before[order] = at - np.maximum.accumulate(np.where(new, at, 0))
        in_text[order] = np.diff(np.flatnonzero(new), append=len(w))[np.cumsum(new) - 1]
        so_far = at - cuts[text]
        again = before / np.maximum(so_far, 1)
        # how often the word before is followed by this one, in training texts other than this
        learned = train[first:last][text]
        lead = np.roll(w, 1)
        lead[0] = words[start - 1]  # an end, as for every text's first token
        lead_in_text = np.where(so_far > 0, np.roll(in_text, 1), 1)
        leads = c[lead] - learned * lead_in_text
        after = np.where(leads > 0, found[start:ends[last - 1]] / np.maximum(leads, 1), often[w])
        # words that only their spelling gives a probability
        unseen = np.flatnonzero((often[w] == 0) & (in_class[w] == 0) & (again == 0) & (after == 0))
        blends = np.zeros((len(BLENDS), last - first))
        # a text's first token has no text so far: that share goes to the corpus frequency, as that of a word before that no other text has
        parts = np.stack([spell[w], often[w], in_class[w], np.where(so_far > 0, again, often[w]), after])
        for i in range(0, len(w), BATCH):
            some = slice(i, i + BATCH)
            p = np.array(BLENDS) @ parts[:, some]
            words_ = unseen[np.searchsorted(unseen, i):np.searchsorted(unseen, i + BATCH)]
            p[:, words_ - i] = 1  # their cost stays in logs: exp() of a long spelling is 0
            log_p = np.log(p, out=p)
            log_p[:, words_ - i] = np.log([[b[0]] for b in BLENDS]) + spelled[w[words_]]
            texts = slice(text[i], text[some][-1] + 1)
            blends[:, texts] += np.add.reduceat(log_p, np.maximum(cuts[texts] - i, 0), axis=1)
        top = blends.max(axis=0)
        score[first:last] = (top + np.log(np.exp(blends - top).mean(axis=0)) - np.log(classes)) / np.log(10)
        first = last
    return known, base, score


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, bits_per_byte double")


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, see SCORES; documents of the held-out fold are scored but not learned from."""
    spark = docs.sparkSession
    before = spark.conf.get(FREE_SHUFFLES, None)
    # what a finished step has shuffled leaves the disk before the next one; results of steps are tables
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        return _score_documents(spark, docs, id_col, text_col)
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def _score_documents(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    docs = folded(docs, id_col, text_col)
    centres = fit_classes(docs)
    parts = keep(chunks(docs, centres), "zstd")
    payloads = parts.where("payload IS NOT NULL").select("chunk", F.lit(-1).alias("part"), "payload")
    tokens = parts.where("payload IS NOT NULL").agg(F.sum("n")).first()[0]
    payloads = payloads.unionByName(keep(pair_counts(payloads.select("chunk", "payload"), tokens)))
    entries = parts.where("payload IS NULL").select((F.shiftleft("chunk", ENTRY_BITS) + F.col("k")).alias("id"), "entry", "n")
    counts = keep(entries.groupBy("entry").agg(F.sum("n").alias("n")), "zstd")
    word = F.substring("entry", 2, 1 << 30)
    per_word = counts.groupBy(word.alias("word")).agg(F.sum("n").alias("c"))
    totals = per_word.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.coalesce(F.sum((F.col("c") > 0).cast("bigint")), F.lit(0)).alias("v")).first()
    n_train, v_train = int(totals.n), int(totals.v)
    n_class = {r.cls: max(r.n, 1) for r in counts.groupBy(F.substring("entry", 1, 1).alias("cls")).agg(F.sum("n").alias("n")).collect()}
    trained = counts.where("n > 0")
    sent = spark.sparkContext.broadcast(predictor_tables(trained))
    # in an order of their own, so that neither retries nor texts outside the training folds change a step
    lessons = trained.repartition(pieces_for(v_train, WORDS_A_LESSON), "entry").sortWithinPartitions(F.xxhash64("entry"), "entry")
    scored = spelling_scores(counts, sent, learn_weights(lessons, sent)).withColumn("word", word)
    # a word's total over its few classes
    scored = scored.withColumn("c", F.sum("n").over(Window.partitionBy("word"))).select("entry", "c", "n", F.col("spelled").cast("float").alias("spelled"))
    replies = entries.select("id", "entry").join(scored, "entry").select(F.col("id").alias("of_id"), "c", "n", "spelled")
    n_classes = len(centres)
    class_sizes = np.array([n_class.get(chr(ord("0") + k), 1) for k in range(n_classes)], float)

    def run(key, payloads, entries_):
        payloads = payloads.sort_by("part")  # the texts, then the counts of pairs in order
        k = entries_.column("of_id").to_numpy() & ((1 << ENTRY_BITS) - 1)
        c, in_class, spelled = np.zeros(len(k), np.int64), np.zeros(len(k)), np.zeros(len(k))
        c[k], in_class[k], spelled[k] = (entries_.column(x).to_numpy() for x in ("c", "n", "spelled"))
        names = [f.split(" ")[0] for f in SCORES.split(", ")]
        batch, words, hashes = _read_payload(payloads.column("payload")[0].as_py())
        cls = np.zeros(len(k), np.int8)
        cls[words] = np.repeat(batch.column("cls").to_numpy(), batch.column("n_tokens").to_numpy())
        in_class /= class_sizes[cls]
        pairs = np.concatenate([_unpack(x.as_py(), 1)[0] for x in payloads.column("payload")[1:]]).astype(np.int64)
        known, base, score = _score_texts(batch, words, _pair_keys(words, hashes), pairs, c, in_class, spelled, n_train, v_train, n_classes)
        bits = -score * np.log2(10) / np.maximum(batch.column("n_bytes").to_numpy(), 1)
        return pa.table([batch.column("doc_id"), batch.column("held_out"), batch.column("n_tokens"), pa.array(known), pa.array(np.full(len(known), n_train)),
                         pa.array(base), pa.array(score), pa.array(bits)], names)

    return payloads.groupBy("chunk").cogroup(replies.groupBy(F.shiftright("of_id", ENTRY_BITS).alias("of_chunk"))).applyInArrow(run, SCORES)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: the score of every document."""
    return score_documents(table(spark, sf_dir, "documents"))
