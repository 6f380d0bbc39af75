"""Language identification by rank-order profiles.

A profile is the list of the most frequent letter n-grams (1 to 3, words padded
by a blank) in order of frequency. A document is given the language whose
profile is nearest by out-of-place distance: the sum, over the document's own
most frequent n-grams, of how far each one's rank is from its rank in the
language's profile, or the largest distance if the profile lacks it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNDETERMINED = "und"
_GRAMS = "lang string, gram long, n long"


def _letter_table() -> np.ndarray:
    """True at the code points of letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letter_codes(text: str, letters: np.ndarray) -> np.ndarray:
    """Lower-case letters as code points; each run of anything else is one blank (32)."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    cp = np.concatenate(([32], np.where(letters[cp], cp, 32), [32]))
    blank = cp == 32
    return cp[~(blank & np.concatenate(([False], blank[:-1])))]


def gram_keys(cp: np.ndarray) -> np.ndarray:
    """All 1-, 2- and 3-grams as numbers: 21 bits a letter, so that no two kinds collide."""
    two = (cp[:-1] << 21) | cp[1:]
    return np.concatenate((cp[cp != 32], two, (two[:-1] << 21) | cp[2:]))


def ranked(keys: np.ndarray, top: int) -> np.ndarray:
    """The ``top`` most frequent keys, most frequent first, ties to the smaller key."""
    uniq, n = np.unique(keys, return_counts=True)
    return uniq[np.lexsort((uniq, -n))[:top]]


def _count_grams(block_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, held, counts = _letter_table(), {}, {}

        def fold(lang):
            parts, _ = held.pop(lang)
            k, n = np.unique(gram_keys(np.concatenate(parts)), return_counts=True)
            if lang in counts:
                k0, n0 = counts[lang]
                k, at = np.unique(np.concatenate((k0, k)), return_inverse=True)
                n = np.bincount(at, np.concatenate((n0, n))).astype(np.int64)
            counts[lang] = k, n

        def out(lang):
            k, n = counts.pop(lang)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(k), pa.string()), pa.array(k, pa.int64()), pa.array(n.astype(np.int64))],
                names=["lang", "gram", "n"])

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py()
                if not text:
                    continue
                parts, size = held.get(lang, ([], 0))
                cp = letter_codes(text, letters)
                if len(cp) > 1:  # else no letter
                    parts.append(cp)
                    held[lang] = parts, size + len(cp)
                    if size + len(cp) > block_chars:
                        fold(lang)
                        if len(counts[lang][0]) > 500_000:
                            yield out(lang)
        for lang in list(held):
            fold(lang)
        for lang in list(counts):
            yield out(lang)

    return run


def learn_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = 400,
                   block_chars: int = 1 << 20) -> dict[str, list[int]]:
    """The profile of every language: the n-gram counts cover all given rows.

    Rows whose language is null or whose text is null or empty add nothing;
    no rows give no profiles. The result has ``top`` numbers a language, so
    its size is bounded by the number of languages, not by the documents.
    """
    grams = (docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
             .select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
             .mapInArrow(_count_grams(block_chars), _GRAMS)
             .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    rows = grams.withColumn("r", rank).where(F.col("r") <= top).collect()
    out: dict[str, list[int]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["r"])):
        out.setdefault(r["lang"], []).append(r["gram"])
    return out


class Profiles:
    """The learned profiles as one table of ranks: a row a language, a column an n-gram."""

    def __init__(self, profiles: dict[str, list[int]], top: int):
        self.langs = sorted(profiles)
        self.top = top
        self.vocab = np.unique(np.array([g for p in profiles.values() for g in p], np.int64))
        self.rank = np.full((len(self.langs), len(self.vocab) + 1), -1, np.int32)
        for i, lang in enumerate(self.langs):
            at = np.searchsorted(self.vocab, np.array(profiles[lang], np.int64))
            self.rank[i, at] = np.arange(len(at))

    def nearest(self, grams: np.ndarray) -> tuple[str, float]:
        """The language at the smallest out-of-place distance, and 1 - distance / largest distance."""
        at = np.searchsorted(self.vocab, grams)
        at[(at < len(self.vocab)) & (self.vocab[np.minimum(at, len(self.vocab) - 1)] != grams)] = len(self.vocab)
        ranks = self.rank[:, at]
        far = np.where(ranks < 0, self.top, np.minimum(np.abs(ranks - np.arange(len(grams))), self.top))
        total = far.sum(axis=1)
        best = int(np.argmin(total))
        return self.langs[best], float(1 - total[best] / (self.top * len(grams)))


def _predict(profiles: dict[str, list[int]], top: int, doc_top: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, model = _letter_table(), Profiles(profiles, top)
        for b in batches:
            langs, scores = [], []
            for text in b.column("__text"):
                text = text.as_py()
                cp = letter_codes(text, letters) if text else np.zeros(0, np.int64)
                lang, score = UNDETERMINED, 0.0
                if len(cp) > 1 and model.langs:
                    lang, score = model.nearest(ranked(gram_keys(cp), doc_top))
                langs.append(lang)
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [b.column(n) for n in names] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*names, "lang_pred", "score"])

    return run


def identify(docs: DataFrame, profiles: dict[str, list[int]], text: str | Column = "text", top: int = 400,
             doc_top: int = 300) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1), in one pass without a shuffle.

    A text that is null or has no letter gets ``und`` and 0, as does every text
    if no language was learned. Equal distances go to the smaller language name.
    Texts are read whole; columns named lang_pred or score are replaced.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "__text")]
    column = F.col(text) if isinstance(text, str) else text
    df = docs.select(*kept, column.alias("__text"))
    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double")
    return df.mapInArrow(_predict(profiles, top, doc_top, kept), schema)
