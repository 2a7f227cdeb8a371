"""Language identification by a bit-sliced Bloom filter of character n-grams.

Learning counts the 3- and 4-grams of every training text per language.  A
gram belongs to a language when its share of the grams of that language is at
least ``min_share`` and at least ``contrast`` times its largest share in any
language.  All languages share one array of positions; position p holds a bit
mask with one bit per language, so two look-ups and one AND return all the
languages that contain a gram.

A text is decided by the number of its grams found per language, corrected
for the false positives expected from how full that language's bits are.

``min_share`` bounds the grams of a language by 1 / min_share and the array
has a fixed number of positions, so what is broadcast does not grow with the
corpus.

Defined cases: a null text, or one without letters, is ``und`` with score 0;
so is every text when nothing could be learned.  Ties go to the language that
sorts first.  Repeated rows count as often as they occur.  Rows with a null
label teach nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import Scratch, fresh, text_groups

SIZES = (3, 4)
POSITIONS = 1 << 22
MIN_SHARE = 2e-6
CONTRAST = 0.2
MAX_LANGUAGES = 512
UNKNOWN = "und"
HELD_GRAMS = 1_000_000  # grams held per language before a task hands them on


def grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per size the 64-bit hashes of all n-grams around letters, and where those of each text begin (one bound more than texts).

    Texts are lower-cased, every run of other characters counts as a blank,
    and a blank stands at both ends.
    """
    parts = [t.lower() for t in texts]
    starts = np.cumsum([0] + [len(p) + 1 for p in parts])
    codes = np.frombuffer((" " + " ".join(parts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    present = np.flatnonzero(np.bincount(codes))
    value = np.zeros(int(present[-1]) + 1, np.uint64)
    for c in present:
        if chr(c).isalpha():
            value[c] = c
    codes = value[codes]
    letter = codes != 0
    keep = np.empty(len(codes), bool)
    keep[0] = True
    np.logical_or(letter[1:], letter[:-1], out=keep[1:])  # one blank of a run is enough
    keep[starts] = True
    begins = np.concatenate([[0], np.cumsum(keep)])[starts]
    codes, letter = codes[keep], letter[keep]
    h = codes
    for n in range(2, max(SIZES) + 1):
        count = len(codes) - n + 1
        if count <= 0:
            return
        h = h[:count] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :]
        if n not in SIZES:
            continue
        inner = letter[1 : count + 1].copy()
        for i in range(2, n - 1):
            inner &= letter[i : i + count]
        at = np.flatnonzero(inner)
        mixed = h[at] + np.uint64(n)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        yield mixed, np.searchsorted(at, begins)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.diff(np.append(first, len(keys)))


def _merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    number, unique = pd.factorize(np.concatenate([k for k, _ in found]))
    return unique, np.bincount(number, np.concatenate([n for _, n in found]), len(unique)).astype(np.int64)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[str, list] = {}

    def given(lang):
        keys, n = _merged(held.pop(lang))
        return pd.DataFrame({"lang": lang, "gram": keys.view(np.int64), "n": n})

    for batch in batches:
        for lang, rows in batch.groupby("lang", sort=False):
            texts = rows["text"].tolist()
            for a, b in text_groups(texts):
                held.setdefault(lang, []).extend(_distinct(h) for h, _ in grams(texts[a:b]) if len(h))
            if held.get(lang):
                if len(held[lang]) >= 64:
                    held[lang] = [_merged(held[lang])]
                if sum(len(k) for k, _ in held[lang]) > HELD_GRAMS:
                    yield given(lang)
    for lang in [g for g in held if held[g]]:
        yield given(lang)


def gram_counts(docs: DataFrame, text: str = "text", label: str = "lang") -> DataFrame:
    """``(lang, gram, n)`` over all rows with a label and a text, combined in each task before the shuffle."""
    rows = docs.select(F.col(text).alias("text"), F.col(label).cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    return rows.mapInPandas(_count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class LanguageModel:
    """Languages in sorted order, the masks (positions x words of 64 languages) and the false-positive rate of each."""

    languages: list[str]
    masks: np.ndarray
    false_rate: np.ndarray


def fit(docs: DataFrame, text: str = "text", label: str = "lang", positions: int = POSITIONS, min_share: float = MIN_SHARE, contrast: float = CONTRAST) -> LanguageModel:
    """Learn the filters from all labelled rows of ``docs``."""
    counts = Scratch(docs.sparkSession).keep(gram_counts(docs, text, label))
    per_lang = counts.groupBy("lang").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "lang").limit(MAX_LANGUAGES)
    totals = {r["lang"]: r["total"] for r in per_lang.collect()}
    languages = sorted(totals)
    if not languages:
        return LanguageModel([], np.zeros((positions, 1), np.uint64), np.zeros(0))
    number = F.create_map(*[F.lit(x) for i, g in enumerate(languages) for x in (g, i)])
    total = F.create_map(*[F.lit(x) for g in languages for x in (g, float(totals[g]))])
    shares = counts.where(F.col("lang").isin(languages)).select("gram", number[F.col("lang")].alias("i"), (F.col("n") / total[F.col("lang")]).alias("share"))
    of_gram = W.partitionBy("gram")  # at most one row per language
    held = shares.withColumn("most", F.max("share").over(of_gram)).where((F.col("share") >= min_share) & (F.col("share") >= contrast * F.col("most")))
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("i") % 64)
    of_word = held.groupBy("gram", F.floor(F.col("i") / 64).cast("int").alias("word")).agg(F.bit_or(mask).alias("mask"))
    bits = positions.bit_length() - 1
    spots = F.array(F.col("gram").bitwiseAND(positions - 1), F.shiftrightunsigned("gram", 64 - bits))
    placed = of_word.select("word", "mask", F.explode(spots).alias("p")).groupBy("p", "word").agg(F.bit_or("mask").alias("mask"))
    found = placed.toPandas()  # at most one row per position and word
    masks = np.zeros((positions, (len(languages) + 63) // 64), np.uint64)
    masks[found["p"].to_numpy(np.int64), found["word"].to_numpy(np.int64)] = found["mask"].to_numpy(np.int64).view(np.uint64)
    fill = np.array([np.count_nonzero(masks[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)) / positions for i in range(len(languages))])
    if len(languages) <= 32:
        masks = masks.astype(np.uint8 if len(languages) <= 8 else np.uint32)
    return LanguageModel(languages, masks, fill**2)


def scores_of(texts: list[str], model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Share of the grams of each text found in each language after correction, and the number of its grams."""
    share, sizes = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts), np.int64)
    bits = len(model.masks).bit_length() - 1
    for a, b in text_groups(texts):
        # A longer text is cut; the few grams across a cut do not matter to a share.
        pieces, owner = [], []
        for i in range(a, b):
            for s in range(0, max(1, len(texts[i])), 1_000_000):
                pieces.append(texts[i][s : s + 1_000_000])
                owner.append(i)
        step = 1 if len(pieces) > b - a else len(pieces)
        for s in range(0, len(pieces), step):
            own = np.array(owner[s : s + step])
            for h, bounds in grams(pieces[s : s + step]):
                np.add.at(sizes, own, np.diff(bounds))
                one, two = h & np.uint64(len(model.masks) - 1), h >> np.uint64(64 - bits)
                for w in range(model.masks.shape[1]):
                    both = model.masks[one, w] & model.masks[two, w]
                    for i in range(64 * w, min(len(model.languages), 64 * w + 64)):
                        seen = np.concatenate([[0], np.cumsum(both >> both.dtype.type(i % 64) & both.dtype.type(1), dtype=np.int64)])
                        np.add.at(share[:, i], own, np.diff(seen[bounds]))
    expected = sizes[:, None] * model.false_rate[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        share = np.where(sizes[:, None] > 0, (share - expected) / np.maximum(sizes[:, None] * (1 - model.false_rate[None, :]), 1e-9), 0.0)
    return np.clip(share, 0, 1), sizes


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the language of each text and the corrected share of its grams that this language contains."""
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.masks, model.false_rate))

    @F.pandas_udf("lang string, score double")
    def decide(texts: pd.Series) -> pd.DataFrame:
        m = LanguageModel(*sent.value)
        plain = [t if t is not None else "" for t in texts]
        share, sizes = scores_of(plain, m)
        known = sizes > 0
        if not m.languages:
            return pd.DataFrame({"lang": [UNKNOWN] * len(plain), "score": 0.0})
        best = share.argmax(axis=1)
        names = np.array(m.languages, object)[best]
        names[~known] = UNKNOWN
        return pd.DataFrame({"lang": names, "score": np.where(known, share[np.arange(len(plain)), best], 0.0)})

    (held,) = fresh(docs, "_decided")
    out = docs.withColumn(held, decide.asNondeterministic()(F.col(text)))
    return out.withColumns({lang: F.col(held)["lang"], score: F.col(held)["score"]}).drop(held)


def taught(remainder: Column) -> Column:
    """Rows to learn from: those whose remainder is known and not 2."""
    return remainder.isNotNull() & (remainder != 2)
