"""Language identification as a mixture: which languages, in which shares.

Model. Each learned language has a smoothed distribution over hashed byte
trigrams of lower-cased text, from its documents' counts. The counts are
summed on executors; languages x buckets numbers reach the driver.

Document. Its trigrams are taken as drawn from a mixture of languages.
Expectation-maximisation estimates the shares; the language set is grown from
the best single language, adding the one that raises the likelihood most while
the gain exceeds a penalty per added language (half the logarithm of the
trigram count, times ``penalty``). Languages that cannot gain that much, by a
bound from the likelihood's concavity, are not tried; no share is too small. ``lang_pred`` is the language with the
largest share, ``score`` that share; ``langs`` and ``shares`` give the set.

Defined cases: a null text or one without a letter (Unicode L) is ``und`` with
score 0; ties go to the language first in code-point order; rows with a null
or empty-model language are not learned from; with nothing to learn from,
every document is ``und``. Whole texts are read; extra columns are kept by
``predict`` and not used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 13
#: Rows learned from per language: a bound in expectation, spread by a hash.
SAMPLE_ROWS = 5_000


def buckets(text: str) -> np.ndarray:
    """Hashed byte trigrams of the lower-cased text, one per position."""
    b = np.frombuffer(text.lower().encode("utf-8", "replace"), dtype=np.uint8).astype(np.uint32)
    if len(b) < 3:
        b = np.concatenate([b, np.full(3 - len(b), 32, dtype=np.uint32)])
    code = b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(32 - BITS)


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    prob: np.ndarray  # language x bucket

    def shares(self, count: np.ndarray, prob: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, float]:
        """Shares of the languages in ``prob`` and the log-likelihood."""
        share = np.full(len(prob), 1.0 / len(prob))
        total = count.sum()
        for _ in range(rounds):
            mix = share @ prob
            new = share * (prob @ (count / mix)) / total
            if np.abs(new - share).max() < 1e-4:
                share = new
                break
            share = new
        return share, float(count @ np.log(share @ prob))

    def predict(self, text: str | None, penalty: float = 4.0) -> tuple[str, float, list[str], list[float]]:
        import regex

        if not text or not self.langs or not regex.search(r"\p{L}", text):
            return "und", 0.0, [], []
        c = np.bincount(buckets(text), minlength=1 << BITS)
        at = np.flatnonzero(c)
        count, prob = c[at].astype(float), self.prob[:, at]
        alone = np.log(prob) @ count
        chosen = [int(alone.argmax())]
        share, like = np.ones(1), float(alone[chosen[0]])
        fee = penalty * 0.5 * math.log(count.sum() + 1)
        while len(chosen) < len(self.langs):
            # The likelihood is concave in the shares: whatever they are, no
            # set with language k gains more than this over the present mix.
            ratio = prob @ (count / (share @ prob[chosen])) / count.sum()
            held = max(1.0, float(ratio[chosen].max()))
            most = count.sum() * np.log(np.maximum(ratio, held))
            tries = []
            for k in range(len(self.langs)):
                if k not in chosen and ratio[k] > 1 and most[k] > fee:
                    s, l = self.shares(count, prob[[*chosen, k]])
                    tries.append((l, -k, s))
            best = max(tries, key=lambda t: t[:2], default=None)
            if best is None or best[0] - like <= fee:
                break
            like, share = best[0], best[2]
            chosen.append(-best[1])
        order = sorted(range(len(chosen)), key=lambda i: (-share[i], self.langs[chosen[i]]))
        langs = [self.langs[chosen[i]] for i in order]
        shares = [min(1.0, float(share[i])) for i in order]
        return langs[0], shares[0], langs, shares


def learn(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, smoothing: float = 0.5) -> Model:
    """Model from ``text`` and ``lang`` of about ``sample_rows`` rows of docs
    per language (chosen by a hash of doc_id and text; all of a language that
    has no more). One number per language and bucket reaches the driver."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    cuts = {r["lang"]: int(sample_rows / r["count"] * (1 << 30)) for r in rows.groupBy("lang").count().collect()
            if r["count"] > sample_rows}
    if cuts:
        cut = F.create_map(*[F.lit(x) for pair in cuts.items() for x in pair])[F.col("lang")]
        place = F.pmod(F.xxhash64("doc_id", "text", F.lit("sample")), F.lit(1 << 30))
        rows = rows.where(F.coalesce(place < cut, F.lit(True)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for b in batches:
            for text, lang in zip(b.column(0), b.column(1), strict=True):
                c = seen.setdefault(lang.as_py(), np.zeros(1 << BITS, dtype=np.int64))
                c += np.bincount(buckets(text.as_py()), minlength=1 << BITS)
        for lang, c in seen.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(at), pa.string()), "bucket": pa.array(at, pa.int32()),
                "n": pa.array(c[at], pa.int64())})

    counts = (rows.select("text", "lang").mapInArrow(count, "lang string, bucket int, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    langs = tuple(sorted(set(counts.column("lang").to_pylist())))
    c = np.full((len(langs), 1 << BITS), smoothing)
    row = np.array([langs.index(x) for x in counts.column("lang").to_pylist()], dtype=np.int64)
    np.add.at(c, (row, counts.column("bucket").to_numpy()), counts.column("n").to_numpy())
    return Model(langs, c / c.sum(axis=1, keepdims=True))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred, score, langs, shares (replacing columns of these
    names); one narrow pass over whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c not in ("lang_pred", "score", "langs", "shares")]
    at = keep.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            got = [m.predict(t.as_py()) for t in b.column(at)]
            cols = list(zip(*got, strict=True)) or [[], [], [], []]
            kinds = (pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                names=[*keep, "lang_pred", "score", "langs", "shares"])

    schema = docs.select(*keep).schema
    for name, kind in (("lang_pred", T.StringType()), ("score", T.DoubleType()),
                       ("langs", T.ArrayType(T.StringType())), ("shares", T.ArrayType(T.DoubleType()))):
        schema = schema.add(name, kind)
    return docs.select(*keep).mapInArrow(run, schema)
