"""Language identification with interpolated Kneser-Ney character models.

One model of order four per language, learned from labelled texts. Characters
are letters in lower case, mapped to 63 codes (a-z have their own, other letters
share the rest by hash), and everything between letters is one boundary. So a
model has at most 2^24 four-character keys whatever the corpus, which bounds what
the driver gathers and broadcasts. The decision is the lowest cross-entropy per
character; entropies far above those of labelled texts of the language reject.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.quantiles import column_quantiles
from tallymark.llm.common import buffers, positional, prepare, slices, stored, table

CODE_BITS = 6
ORDER = 4
#: Rejection levels are set on all distinct labelled texts; the entropies of up to so many go to the driver, more stay with the tasks.
CALIBRATION_TEXTS = 4000
#: Languages whose levels one aggregate sets.
LEVELS_AT_ONCE = 16
#: Rejected above so many times the distance of the 99.9th percentile.
REJECT_FACTOR = 2.0
#: Nats a character of random letters; texts nearer to the language than to these stay, however few texts set the level.
RANDOM = math.log(27)
#: Characters that count as independent in the score.
SCORE_LENGTH = 40

_codes: list[np.ndarray] = []


def letter_codes() -> np.ndarray:
    """Code of each character of the basic plane; 0 for all but letters."""
    if not _codes:
        lut = np.zeros(1 << 16, np.uint8)
        for cp in range(1 << 16):
            ch = chr(cp)
            if not unicodedata.category(ch).startswith("L"):
                continue
            low = ord(ch.lower()[0])
            lut[cp] = low - 96 if 97 <= low <= 122 else 27 + (low * 40503 >> 4) % 37
        _codes.append(lut)
    return _codes[0]


def gram_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Four-character keys of all texts, the last character in the lowest bits;
    per text the index of its first key, and whether it has a letter."""
    text = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    plane = letter_codes()
    code = plane[np.minimum(text, 0xFFFF)]
    high = np.flatnonzero(text > 0xFFFF)
    code[high] = [27 + (int(c) * 40503 >> 4) % 37 if chr(c).isalpha() else 0 for c in text[high]]
    keep = code > 0
    keep[1:] |= code[:-1] > 0
    inner = begins[1:-1]
    inner = inner[(inner > 0) & (inner < len(code))]
    keep[inner] = code[inner] > 0  # a text starts after a boundary
    if len(keep):
        keep[0] = code[0] > 0
    kept = np.concatenate([[0], np.cumsum(keep)])[begins]
    letters = np.concatenate([[0], np.cumsum(code > 0)])[begins]
    lead = ORDER - 1
    texts = len(offsets) - 1
    line = np.zeros(kept[-1] + lead * texts, np.uint32)
    row = np.repeat(np.arange(texts), np.diff(kept))
    line[np.arange(kept[-1]) + lead * (row + 1)] = code[keep]
    at = np.arange(kept[-1]) + lead * (row + 1)
    keys = line[at]
    for back in range(1, ORDER):
        keys = keys | line[at - back] << np.uint32(CODE_BITS * back)
    return keys, kept, np.diff(letters) > 0


@dataclass
class Model:
    """Sorted keys with the log-probabilities of each language, and for keys
    that none has seen, back-off weights of contexts and order-three values."""

    languages: list[str]
    keys: np.ndarray
    logs: np.ndarray
    gamma: np.ndarray
    lower: np.ndarray
    #: language -> (usual entropy, 99.9th percentile of what lies above it, same times the root of the length)
    limits: dict[str, tuple[float, float, float]] = field(default_factory=dict)

    def entropies(self, keys: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Nats per character of each text (rows) in each language (columns)."""
        distinct, inverse = np.unique(keys, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        at[at == len(self.keys)] = 0
        values = self.logs[at].astype(np.float64)
        unseen = self.keys[at] != distinct
        values[unseen] = self.gamma[distinct[unseen] >> CODE_BITS] + self.lower[distinct[unseen] & _mask(3)]
        total = np.zeros((len(first), len(self.languages)))
        total[1:] = np.cumsum(values[inverse], axis=0)[first[1:] - 1] if len(keys) else 0
        total[first == 0] = 0
        n = np.diff(first)
        return -np.diff(total, axis=0) / np.maximum(n, 1)[:, None]


def _mask(order: int) -> int:
    return (1 << CODE_BITS * order) - 1


def _discount(counts: np.ndarray) -> float:
    ones, twos = int((counts == 1).sum()), int((counts == 2).sum())
    return ones / (ones + 2 * twos) if ones and twos else 0.5


def kneser_ney(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From sorted four-character keys and counts: their probabilities, the
    back-off weight of every context, and probabilities of all order-three keys.
    Orders below the highest count in how many distinct contexts a key stands."""
    by_order = {ORDER: (keys, counts.astype(np.float64))}
    for order in range(ORDER - 1, 0, -1):
        longer = by_order[order + 1][0]
        by_order[order] = tuple(
            x.astype(np.float64) if i else x
            for i, x in enumerate(np.unique(longer & _mask(order), return_counts=True))
        )
    k, c = by_order[1]
    d = _discount(c)
    lower = np.full(1 << CODE_BITS, d * len(k) / c.sum() / (1 << CODE_BITS))
    lower[k] += np.maximum(c - d, 0) / c.sum()
    for order in range(2, ORDER + 1):
        k, c = by_order[order]
        d = _discount(c)
        context, size = k >> CODE_BITS, 1 << CODE_BITS * (order - 1)
        total = np.bincount(context, c, size)
        kinds = np.bincount(context, minlength=size)
        seen = np.maximum(c - d, 0) / total[context]
        weight = np.where(total > 0, d * kinds / np.maximum(total, 1), 1.0)
        if order == ORDER:
            return seen + weight[context] * lower[k & _mask(order - 1)], weight, lower
        every = np.arange(1 << CODE_BITS * order)
        full = weight[every >> CODE_BITS] * lower[every & _mask(order - 1)]
        full[k] += seen
        lower = full
    raise AssertionError


def _count_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged(parts):
        keys = np.concatenate([p[0] for p in parts])
        distinct, inverse = np.unique(keys, return_inverse=True)
        return distinct, np.bincount(inverse, np.concatenate([p[1] for p in parts])).astype(np.int64)

    for batch in batches:
        data, offsets = buffers(batch.column(1))
        names = np.array(batch.column(0).to_pylist(), object)
        for lo, hi, part, own in slices(data, offsets):
            keys, first, _ = gram_keys(part, own)
            label = np.repeat(names[lo:hi], np.diff(first))
            for name in set(names[lo:hi]):
                parts = held.setdefault(name, [])
                parts.append(np.unique(keys[label == name], return_counts=True))
                if len(parts) >= 16:
                    held[name] = [merged(parts)]
    for name, parts in held.items():
        keys, counts = merged(parts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(keys), pa.string()), pa.array(keys.astype(np.int32)), pa.array(counts)],
            ["lang", "key", "n"],
        )


def learn(labelled: DataFrame) -> Model | None:
    """Models from rows of (lang, text); counts cover every row. None without any."""
    counts = labelled.mapInArrow(_count_keys, "lang string, key int, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    model = _estimated(counts)  # what it takes is let go before the levels are set
    if model is not None:
        _calibrate(labelled.sparkSession, labelled, model)
    return model


def _estimated(counts: DataFrame) -> Model | None:
    """Models from (lang, key, n), which come to the driver as columns, not as a row object each."""
    found = counts.toArrow()
    if not found.num_rows:
        return None
    label, key, n = found["lang"], found["key"].to_numpy().astype(np.int64), found["n"].to_numpy()
    languages = sorted(pc.unique(label).to_pylist())
    parts = {}
    for name in languages:
        own = np.flatnonzero(pc.equal(label, name).to_numpy())
        own = own[np.argsort(key[own])]
        parts[name] = (key[own], *kneser_ney(key[own], n[own]))
    union = np.unique(np.concatenate([p[0] for p in parts.values()]))
    logs = np.empty((len(union), len(languages)), np.float32)
    for j, name in enumerate(languages):
        keys, p, weight, lower = parts[name]
        values = weight[union >> CODE_BITS] * lower[union & _mask(ORDER - 1)]
        values[np.searchsorted(union, keys)] = p
        logs[:, j] = np.log(values)
    return Model(
        languages,
        union.astype(np.uint32),
        logs,
        np.log(np.stack([parts[n][2] for n in languages], axis=1)).astype(np.float32),
        np.log(np.stack([parts[n][3] for n in languages], axis=1)).astype(np.float32),
    )


def _calibrate(spark: SparkSession, labelled: DataFrame, model: Model) -> None:
    """Sets the limits of every language from all its distinct labelled texts with a letter."""
    shared = spark.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for lo, hi, part, own in slices(data, offsets):
                keys, first, _ = gram_keys(part, own)
                e = shared.value.entropies(keys, first)
                n = np.diff(first)
                names, digests = (batch.column(i).slice(lo, hi - lo) for i in (0, 2))
                column = [shared.value.languages.index(x) for x in names.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [names, digests, pa.array(e[np.arange(hi - lo), column]), pa.array(n)], ["lang", "digest", "e", "n"]
                )

    # texts stay where they are: copies are told by a digest, and a few numbers a text are shuffled
    digested = labelled.select("lang", "text", F.md5(F.col("text").cast("binary")).alias("digest"))
    found = digested.mapInArrow(score, "lang string, digest string, e double, n long").filter("n > 0")
    scored = stored(found.dropDuplicates(["lang", "digest"]).select("lang", "e", "n"), "levels")
    model.limits.update(_levels(scored, model.languages))


def _levels(scored: DataFrame, languages: list[str]) -> dict[str, tuple[float, float, float]]:
    """`Model.limits` from (lang, e, n) rows of `languages`, over all of them."""
    held = scored.limit(CALIBRATION_TEXTS + 1).collect()
    out = {}
    if len(held) <= CALIBRATION_TEXTS:
        for name in languages:
            own = np.array([(r["e"], r["n"]) for r in held if r["lang"] == name], float)
            if len(own):
                usual = float(np.median(own[:, 0]))
                above = np.maximum(own[:, 0] - usual, 0)
                out[name] = (usual, float(np.quantile(above, 0.999)), float(np.quantile(above * np.sqrt(own[:, 1]), 0.999)))
        return out
    del held
    # languages as columns of a few aggregates: no shuffle of the texts' rows
    for at in range(0, len(languages), LEVELS_AT_ONCE):
        some = languages[at : at + LEVELS_AT_ONCE]
        middle = column_quantiles(scored, {x: (F.when(F.col("lang") == F.lit(x), F.col("e")), {"usual": 0.5}) for x in some})
        wanted = {}
        for name in some:
            if middle[name]["n"]:
                above = F.when(F.col("lang") == F.lit(name), F.greatest(F.col("e") - F.lit(middle[name]["usual"]), F.lit(0.0)))
                wanted |= {(name, 0): (above, {"far": 0.999}), (name, 1): (above * F.sqrt("n"), {"far": 0.999})}
        reach = column_quantiles(scored, wanted)
        out |= {x: (middle[x]["usual"], reach[x, 0]["far"], reach[x, 1]["far"]) for x, kind in wanted if not kind}
    return out


def identify(
    documents: DataFrame, learn_from: Column, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """`documents` with lang_pred, score (0 to 1), entropy and rejected.

    Learns from the rows where `learn_from` holds and `lang` is not null; only
    the text decides. Null texts and texts without a letter get `und`, score 0,
    and are rejected; so is every text if nothing could be learned and it has
    no letter. Rejected as well are texts whose entropy no labelled text of the
    language comes near, or, where no labelled text set a level, no better than
    random letters. Ties go to the first language by name. Copies and
    repeated rows agree; columns of the added names are replaced.
    """
    spark = documents.sparkSession
    prepare(spark)
    added = ("lang_pred", "score", "entropy", "rejected")
    carried, columns, new = positional(documents, added)
    names = carried.columns
    labelled = documents.filter(learn_from).toDF(*[f"c{i}" for i in range(len(documents.columns))])
    labelled = labelled.filter(F.col(new[lang]).isNotNull()).select(
        F.col(new[lang]).cast("string").alias("lang"), F.coalesce(F.col(new[text]), F.lit("")).alias("text")
    )
    model = spark.sparkContext.broadcast(learn(labelled))  # bounded by languages x 2^24 keys
    at = names.index(new[text])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            data, offsets = buffers(batch.column(at))
            for lo, hi, part, own in slices(data, offsets):
                keys, first, lettered = gram_keys(part, own)
                n = np.diff(first)
                pred, score, best = np.full(hi - lo, "und", object), np.zeros(hi - lo), np.full(hi - lo, np.nan)
                rejected = ~lettered
                if m is not None:
                    e = m.entropies(keys, first)
                    top = e.argmin(axis=1)
                    best = e[np.arange(len(e)), top]
                    steps = np.minimum(n, SCORE_LENGTH)[:, None]
                    share = 1.0 / np.exp((best[:, None] - e) * steps).sum(axis=1)
                    limits = np.array([m.limits.get(x, (RANDOM, 0.0, 0.0)) for x in m.languages])[top]
                    far = REJECT_FACTOR * np.maximum(limits[:, 1], limits[:, 2] / np.sqrt(np.maximum(n, 1)))
                    far = np.maximum(far, (RANDOM - limits[:, 0]) / 2)
                    rejected = ~lettered | (best > limits[:, 0] + far)
                    pred[lettered] = np.array(m.languages, object)[top[lettered]]
                    score[lettered] = share[lettered]
                entropy = pa.array(np.where(lettered, best, np.nan), from_pandas=True)
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(lo, hi - lo).columns, pa.array(pred, pa.string()), pa.array(score), entropy, pa.array(rejected)],
                    [*names, *added],
                )

    schema = ", ".join(f"{n} {t}" for n, t in carried.dtypes)
    return carried.mapInArrow(run, f"{schema}, lang_pred string, score double, entropy double, rejected boolean").toDF(
        *columns, *added
    )


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def drop_unidentified(documents: DataFrame) -> DataFrame:
    """`documents` without the rows that identification rejects: null and empty texts, texts
    without letters, and texts nearer to random letters than to any language learned. Very long
    texts are judged whole, repeated rows fare alike, an empty table stays empty."""
    renamed, columns, new = positional(documents)
    found = identify(renamed, ~held_out(new["doc_id"]), new["text"], new["lang"])
    return found.filter(~F.col("rejected")).select(*renamed.columns).toDF(*columns)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of `documents`, a row per row; edge cases as in `identify` (`und` and score 0 for null
    texts and those without letters, ties to the first language by name)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs, ~held_out()).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
