"""Cross-tokenizer alignment: which tokens of two tokenizers cover one another.

Tokenizer A (byte-level BPE) encodes a space and the text, tokenizer B (BPE
with a word mark) the text, to which it adds the space. Both token sequences
then cover the same bytes. Byte offsets at which tokens of both end cut them
into groups; tokens whose bytes overlap are linked. Over the whole corpus the
links of an id pair are counted, and each document is measured by its links'
counts.

Plan.

1. Exact-text deduplication: rows are grouped by their full text (partial
   counts first, so copies do not travel), and only distinct texts go on, with
   their multiplicity.
2. Each distinct text is tokenised and aligned once. Its measures and its
   distinct id pairs (one blob) are written once.
3. Pair counts: links x multiplicity, added up per task in bounded dictionaries,
   then by a grouped sum. The highest count per B id joins them.
4. The pairs of the highest counts, at most ``HELD_PAIRS`` of them, go to all
   tasks and value most links where the blobs lie. The links of rarer pairs,
   few by the law of word frequencies, are valued by a shuffle join on the
   pair. Both ways are exact; the bound does not grow with the data.
5. Measures return to the doc_ids by the text's SHA-256. Texts that hold more
   than 1 / ``HEAVY`` of all rows, fewer than ``HEAVY`` by count, are joined
   by broadcast, so no hot text is shuffled.

Defined cases: a null or empty text, or one whose joined A or B bytes differ
from space + text (a literal word mark), has no tokens: zeros and an empty
string. Repeated rows stay rows; null doc_ids stay; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.byte_bpe import ByteBpe, token_bytes
from tidemark.llm.common import heavy_join, stage, sub_batches

MARK = "▁"
#: Pairs valued by broadcast, 16 bytes each; dictionary entries per task.
HELD_PAIRS, TASK_PAIRS = 1 << 20, 1 << 18
HEAVY = 1_000


class Aligner:
    """Encodes whole texts with both tokenizers and aligns them, a batch of
    texts at a time: their bytes lie one behind the other, and marks at token
    ends give links and groups of all texts in a few array steps."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self._a = ByteBpe(a_path, plain_specials=True)
        self._b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        tokens = token_bytes(a_path)
        size = max(tokens.values()) + 1
        self._a_bytes = [b""] * size
        for token, i in tokens.items():
            self._a_bytes[i] = token
        self._b_bytes = []
        for i in range(self._b.get_piece_size()):
            piece = self._b.id_to_piece(i)
            self._b_bytes.append(bytes([int(piece[3:-1], 16)]) if self._b.is_byte(i)
                                 else b"" if self._b.is_control(i) or self._b.is_unknown(i)
                                 else piece.replace(MARK, " ").encode())
        self._a_len = np.array([len(x) for x in self._a_bytes], dtype=np.int64)
        self._b_len = np.array([len(x) for x in self._b_bytes], dtype=np.int64)
        #: A pair's code: its A id times ``base`` plus its B id.
        self.base = len(self._b_bytes)
        self.code = "<u4" if size * self.base <= 1 << 32 else "<u8"
        self._ids = max(size, self.base)
        self._shown = [f"{i}{end}".encode() for end in ",|;" for i in range(self._ids)]

    def texts(self, texts: Sequence[str]) -> list[tuple[np.ndarray, bytes, int, int, int] | None]:
        """Per text the codes of its links, its groups as text, and how many A
        tokens, B tokens and groups it has; None where it has no tokens."""
        out: list = [None] * len(texts)
        kept, a_ids, b_ids, sizes = [], [], [], []
        both = zip(texts, self._a.encode([" " + t for t in texts]), self._b.encode(list(texts), num_threads=1), strict=True)
        for row, (text, a, b) in enumerate(both):
            a, whole = np.frombuffer(a, "<u4"), b" " + text.encode()
            if (text and b"".join(map(self._a_bytes.__getitem__, a.tolist())) == whole
                    and b"".join(map(self._b_bytes.__getitem__, b)) == whole):
                kept.append(row), a_ids.append(a.astype(np.int64)), b_ids.append(np.array(b, np.int64)), sizes.append(len(whole))
        if not kept:
            return out
        a, b = np.concatenate(a_ids), np.concatenate(b_ids)
        ends = np.zeros((2, sum(sizes) + 1), dtype=bool)
        ends[0, np.cumsum(self._a_len[a])] = True
        ends[1, np.cumsum(self._b_len[b])] = True
        at = np.flatnonzero(ends.any(axis=0))       # every end of a token closes one link
        shared = np.flatnonzero(ends.all(axis=0))   # every shared end closes one group
        # Tokens that end before a place: the token that covers it is the next.
        a_before, b_before = (np.cumsum(e) - e for e in ends)
        codes = (a[a_before[at]] * self.base + b[b_before[at]]).astype(self.code)
        a_to, b_to = a_before[shared] + 1, b_before[shared] + 1
        a_from, b_from = np.concatenate([[0], a_to[:-1]]), np.concatenate([[0], b_to[:-1]])
        na, nb = a_to - a_from, b_to - b_from
        first = np.cumsum(na + nb) - na - nb
        shown = np.empty(len(a) + len(b), dtype=np.int64)
        shown[np.repeat(first - a_from, na) + np.arange(len(a))] = a
        shown[np.repeat(first + na - b_from, nb) + np.arange(len(b))] = b
        shown[first + na - 1] += self._ids          # the group's last A id
        shown[first + na + nb - 1] += 2 * self._ids
        parts = list(map(self._shown.__getitem__, shown.tolist()))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        link_at = np.searchsorted(at, bounds, "right")
        group_at = np.searchsorted(shared, bounds, "right")
        part_at = np.concatenate([first, [len(parts)]])[group_at].tolist()
        link_at, group_at = link_at.tolist(), group_at.tolist()
        for k, row in enumerate(kept):
            out[row] = (codes[link_at[k]:link_at[k + 1]], b"".join(parts[part_at[k]:part_at[k + 1]])[:-1],
                        len(a_ids[k]), len(b_ids[k]), group_at[k + 1] - group_at[k])
        return out


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """The worker process's aligner, made once."""
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


_ALIGNED = ("key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups string, "
            "pairs binary, links binary")


def distinct_texts(docs: DataFrame) -> DataFrame:
    """text, copies: every distinct non-empty text, dealt by the full text."""
    return docs.where(F.length("text") > 0).groupBy("text").agg(F.count(F.lit(1)).alias("copies"))


def align_texts(texts: DataFrame, a_path: str, b_path: str, digest: bool = True) -> DataFrame:
    """Of each distinct text its measures, ``groups`` (or with ``digest`` their
    SHA-256) and its distinct pairs: ``pairs`` (ascending codes) and ``links``
    (their numbers of links, unsigned 32-bit), one narrow pass. ``key`` is the
    text's SHA-256."""
    kinds = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}
    fields = [(c.split()[0], kinds[c.split()[1]]) for c in _ALIGNED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(a_path, b_path)
        for b in sub_batches(batches):
            rows = []
            texts = b.column(0).to_pylist()
            for text, copies, got in zip(texts, b.column(1).to_pylist(), al.texts(texts), strict=True):
                key = hashlib.sha256(text.encode()).digest()
                if got is None:
                    rows.append((key, copies, 0, 0, 0, 0, "", b"", b""))
                    continue
                codes, groups, n_a, n_b, n_groups = got
                pairs, links = np.unique(codes, return_counts=True)
                shown = hashlib.sha256(groups).hexdigest() if digest else groups.decode()
                rows.append((key, copies, n_a, n_b, n_groups, len(codes), shown,
                             pairs.tobytes(), links.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)],
                names=[n for n, _ in fields])

    return texts.select("text", "copies").mapInArrow(run, _ALIGNED)


def pair_counts(aligned: DataFrame, code: str) -> DataFrame:
    """pair, count: links of each pair over the corpus, copies counted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64), np.empty(0, np.int64)]

        def added(pairs: list[np.ndarray], counts: list[np.ndarray]) -> list[np.ndarray]:
            p, at = np.unique(np.concatenate(pairs), return_inverse=True)
            return [p, np.bincount(at, np.concatenate(counts).astype(np.float64), len(p)).astype(np.int64)]

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"pair": pa.array(held[0]), "count": pa.array(held[1])})

        for b in batches:
            for part in sub_batches(iter([b]), 512):
                ps = [np.frombuffer(x.as_buffer(), code).astype(np.int64) for x in part.column("pairs")]
                ns = [np.frombuffer(x.as_buffer(), "<u4").astype(np.int64) * c for x, c in
                      zip(part.column("links"), part.column("copies").to_pylist(), strict=True)]
                held = added([held[0], *ps], [held[1], *ns])
                if len(held[0]) > TASK_PAIRS:
                    yield out()
                    held = [np.empty(0, np.int64), np.empty(0, np.int64)]
        yield out()

    parts = aligned.where("n_links > 0").select("pairs", "links", "copies").mapInArrow(run, "pair long, count long")
    return parts.groupBy("pair").agg(F.sum("count").alias("count"))


def _highest(counts: DataFrame, base: int) -> DataFrame:
    """pair, count, best: whether the count is its B id's highest. The window
    ranks id pairs, not rows: a B id has as many as A has ids at most."""
    top = F.max("count").over(Window.partitionBy(F.col("pair") % base))
    return counts.select("pair", "count", (F.col("count") == top).alias("best"))


def _common(pairs: DataFrame, bound: int) -> int:
    """The lowest power of two such that at most ``bound`` pairs count as much.
    At most 64 rows reach the driver."""
    by = F.floor(F.log2("count")).cast("int")
    n = 0
    for r in sorted(pairs.groupBy(by.alias("power")).count().collect(), key=lambda r: -r["power"]):
        n += r["count"]
        if n > bound:
            return 1 << (r["power"] + 1)
    return 1


def align_table(docs: DataFrame, a_path: str, b_path: str, digest: bool = True,
                held_pairs: int = HELD_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and ``groups``
    (with ``digest``: groups_sha256) of every document."""
    al = aligner(a_path, b_path)
    code, base = al.code, al.base
    aligned = stage(align_texts(distinct_texts(docs), a_path, b_path, digest), "aligned")
    pairs = stage(_highest(pair_counts(aligned, code), base), "pair-counts")
    cut = _common(pairs, held_pairs)
    top = pairs.where(F.col("count") >= cut).toArrow()  # at most held_pairs rows
    by = np.argsort(top.column("pair").to_numpy())
    shared = docs.sparkSession.sparkContext.broadcast(
        (top.column("pair").to_numpy()[by], top.column("count").to_numpy()[by],
         np.array(top.column("best").to_pylist(), dtype=bool)[by]))

    def value(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count, best = shared.value
        for b in batches:
            for part in sub_batches(iter([b]), 512):
                n_best, total, rare, rare_n = [], [], [], []
                for p, n in zip(part.column("pairs"), part.column("links"), strict=True):
                    p = np.frombuffer(p.as_buffer(), code).astype(np.int64)
                    n = np.frombuffer(n.as_buffer(), "<u4").astype(np.int64)
                    at = np.minimum(np.searchsorted(known, p), max(0, len(known) - 1))
                    hit = known[at] == p if len(known) else np.zeros(len(p), bool)
                    total.append(int((n[hit] * count[at[hit]]).sum()))
                    n_best.append(int(n[hit][best[at[hit]]].sum()))
                    rare.append(p[~hit])
                    rare_n.append(n[~hit])
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(n_best, pa.int64()), pa.array(total, pa.int64()),
                     pa.array(rare, pa.list_(pa.int64())), pa.array(rare_n, pa.list_(pa.int64()))],
                    names=["key", "n_best", "count_sum", "rare", "rare_links"])

    valued = aligned.where("n_links > 0").select("key", "pairs", "links").mapInArrow(
        value, "key binary, n_best long, count_sum long, rare array<long>, rare_links array<long>")
    measures = aligned.select("key", "copies", "n_a", "n_b", "n_groups", "n_links", "groups")
    sums = valued
    if cut > 1:
        sums = stage(valued, "pairs-valued")
        rest = sums.where(F.size("rare") > 0).select("key", F.explode(F.arrays_zip("rare", "rare_links")).alias("r"))
        rest = rest.select("key", F.col("r.rare").alias("pair"), F.col("r.rare_links").alias("n"))
        rest = rest.join(pairs.where(F.col("count") < cut), "pair").select(
            "key", F.when(F.col("best"), F.col("n")).otherwise(0).alias("n_best"), (F.col("n") * F.col("count")).alias("count_sum"))
        sums = sums.select("key", "n_best", "count_sum").unionByName(rest)
        sums = sums.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    whole = measures.join(sums.select("key", "n_best", "count_sum"), "key", "left")
    shown = "groups_sha256" if digest else "groups"
    whole = stage(whole.select(
        "key", "copies", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), F.col("groups").alias(shown)), "text-measures")
    key = F.when(F.length("text") > 0, F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    rows = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key")), "text-keys")  # three readers
    out = heavy_join(rows, whole, "key", "copies", HEAVY)
    numbers = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    return out.select("doc_id", *[F.coalesce(c, zero).alias(c) for c in numbers],
                      F.coalesce(shown, F.lit("")).alias(shown))
