"""Secret scans with formats inferred from labelled credentials.

Fixed patterns find base secrets; their values are labelled credentials. From
these, and from long runs outside of them as the contrast, a prefix tree of
character classes is built per kind and its statistically compatible states are
merged into a probabilistic automaton. Every other long run of credential
characters is a candidate: it is reported if its format is about as likely as
that of labelled ones and clearly more likely than among ordinary runs.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm.common import positional, prepare, stored, table

# Fixed patterns of the base kinds, with the group whose length counts and the least length.
_KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


BASE = {
    "assign": (
        re.compile(
            "(" + "|".join(map(_either_case, _KEYWORDS)) + ")[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
        ),
        2,
        6,
    ),
    "access": (re.compile("AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile("[0-9a-f]{24,}"), 0, 24),  # runs are maximal, so shorter matches are just those that fail
}
ORDER = {kind: i for i, kind in enumerate(BASE)}

CANDIDATE = re.compile("[A-Za-z0-9+/_.=-]{16,}")
#: Prefix-tree states of a kind that the driver merges at most: those with the most arrivals. Their number
#: bounds the automaton's structure; its probabilities and levels count every format of any length.
TREE_STATES = 50_000
#: Depth of the prefix tree that the first pass counts; each further pass doubles it where states go on.
FIRST_DEPTH = 16
#: Levels are read off histograms of this step, in nats a character.
STEP = 0.001
#: A kind needs so many labelled values.
LEAST_LABELLED = 20
#: Confidence of the merge test, and the least gain over ordinary runs, in nats a character.
ALPHA, MARGIN = 0.05, 0.25
_FLOOR = math.log(1e-4)

_CLASSES = np.arange(256, dtype=np.uint8)
_CLASSES[ord("0") : ord("9") + 1] = ord("0")
_CLASSES[ord("a") : ord("f") + 1] = ord("a")
_CLASSES[ord("g") : ord("z") + 1] = ord("g")
_CLASSES[ord("A") : ord("F") + 1] = ord("A")
_CLASSES[ord("G") : ord("Z") + 1] = ord("G")
_TABLE = bytes(_CLASSES)


def char_format(value: str) -> str:
    """The value with digits, a-f, other small, A-F and other capital letters each one sign."""
    return value.encode("latin-1").translate(_TABLE).decode("latin-1")


class _State:
    __slots__ = ("arrivals", "ends", "counts", "next", "cut")

    def __init__(self):
        self.arrivals, self.ends = 0, 0
        self.cut = False  # too few arrivals to be told from other states: what follows isn't known
        self.counts: dict[str, int] = {}
        self.next: dict[str, _State] = {}


class Automaton:
    """A probabilistic automaton from weighted strings, by state merging."""

    def __init__(self, strings: dict[str, int], alpha: float = ALPHA):
        root = _State()
        for text in sorted(strings):
            weight, state = strings[text], root
            state.arrivals += weight
            for c in text:
                state.counts[c] = state.counts.get(c, 0) + weight
                state = state.next.setdefault(c, _State())
                state.arrivals += weight
            state.ends += weight
        self._merge(root, alpha)

    @classmethod
    def of_tree(cls, root: _State, alpha: float = ALPHA) -> Automaton:
        out = cls.__new__(cls)
        out._merge(root, alpha)
        return out

    def _merge(self, root: _State, alpha: float) -> None:
        self._spread = math.sqrt(0.5 * math.log(2 / alpha))
        kept = [root]
        border = [(root, c) for c in sorted(root.next) if not root.next[c].cut]
        while border:
            parent, c = border.pop(0)
            state = parent.next[c]
            match = next((k for k in kept if self._alike(k, state)), None)
            if match is not None:
                parent.next[c] = match
                self._fold(match, state)
                known = set(map(id, kept))
                border = [(k, x) for k in kept for x in sorted(k.next) if not k.next[x].cut and id(k.next[x]) not in known]
            else:
                kept.append(state)
                border += [(state, x) for x in sorted(state.next) if not state.next[x].cut]
        number = {id(k): i for i, k in enumerate(kept)}
        self.steps = [
            {c: (math.log(n / k.arrivals), number.get(id(k.next[c]), 0)) for c, n in k.counts.items()} for k in kept
        ]
        self.ends = [math.log(k.ends / k.arrivals) if k.ends else _FLOOR for k in kept]

    def _far(self, a: int, n: int, b: int, m: int) -> bool:
        return abs(a / n - b / m) > self._spread * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _alike(self, a: _State, b: _State) -> bool:
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            if x.cut or y.cut:
                continue
            if self._far(x.ends, x.arrivals, y.ends, y.arrivals):
                return False
            for c in x.counts.keys() | y.counts.keys():
                if self._far(x.counts.get(c, 0), x.arrivals, y.counts.get(c, 0), y.arrivals):
                    return False
                if c in x.next and c in y.next:
                    todo.append((x.next[c], y.next[c]))
        return True

    @staticmethod
    def _fold(into: _State, tree: _State) -> None:
        todo = [(into, tree)]
        while todo:
            x, y = todo.pop()
            x.arrivals += y.arrivals
            x.ends += y.ends
            for c, n in y.counts.items():
                x.counts[c] = x.counts.get(c, 0) + n
                if c not in x.next or x.next[c].cut:
                    x.next[c] = y.next[c]
                elif not y.next[c].cut:
                    todo.append((x.next[c], y.next[c]))

    def count(self, text: str, n: int, into: Counter) -> None:
        """Add the visits of (state, sign), the end being the empty sign."""
        state = 0
        for c in text:
            into[state, c] += n
            state = self.steps[state].get(c, (_FLOOR, 0))[1]
        into[state, ""] += n

    def reweigh(self, visits: dict[tuple[int, str], int]) -> None:
        """Probabilities from such visits of all strings; the structure stays."""
        arrivals: Counter = Counter()
        for (state, _), n in visits.items():
            arrivals[state] += n
        old, self.steps = self.steps, [{} for _ in self.steps]
        self.ends = [_FLOOR] * len(self.steps)
        for (state, c), n in visits.items():
            log = math.log(n / arrivals[state])
            if c:
                self.steps[state][c] = (log, old[state].get(c, (_FLOOR, 0))[1])
            else:
                self.ends[state] = log

    def likelihood(self, text: str) -> float:
        """Log-likelihood a character, the end counting as one."""
        state, total = 0, 0.0
        for c in text:
            log, state = self.steps[state].get(c, (_FLOOR, 0))
            total += log
        return (total + self.ends[state]) / (len(text) + 1)


class Formats:
    """Automata of the labelled kinds and of ordinary runs, with the levels to pass."""

    def __init__(self, ordinary: Automaton | None, kinds: dict[str, tuple[Automaton, float, float]]):
        self.ordinary, self.kinds = ordinary, kinds

    def best(self, form: str) -> tuple[str, float] | None:
        """The kind that a candidate's format passes for, with its gain."""
        other = self.ordinary.likelihood(form) if self.ordinary else _FLOOR
        passed = []
        for kind, (automaton, least, margin) in self.kinds.items():
            own = automaton.likelihood(form)
            if own >= least and own - other >= margin:
                passed.append((own - other, kind))
        return max(passed)[::-1] if passed else None


def _level(pairs: list[tuple[float, int]], share: float) -> float:
    """The value at which `share` of the weight is reached, in the order given."""
    total, so_far = sum(n for _, n in pairs), 0
    for value, n in pairs:
        so_far += n
        if so_far > share * total:
            return value
    return pairs[-1][0]


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) by start, then kind as listed."""
    out = []
    for kind, (pattern, group, least) in BASE.items():
        out += [
            (m.start(), m.end(), kind, m.group(group)) for m in pattern.finditer(text) if len(m.group(group)) >= least
        ]
    return sorted(out, key=lambda s: (s[0], ORDER[s[2]]))


def candidates(text: str, base: list[tuple[int, int, str, str]]) -> Iterator[tuple[int, int, str]]:
    """Long runs that no base span touches."""
    at, end, spans = 0, 0, [(s, e) for s, e, _, _ in base]
    for m in CANDIDATE.finditer(text):
        while at < len(spans) and spans[at][0] < m.end():
            end = max(end, spans[at][1])
            at += 1
        if end <= m.start():
            yield m.start(), m.end(), char_format(m.group())


def learn_formats(documents: DataFrame, text: str = "text") -> Formats:
    """Automata of the formats of all documents.

    Spark counts the formats and the states of their prefix trees. The driver
    merges each kind's states with the most arrivals, TREE_STATES at most (the
    merge test can't tell states with few arrivals apart); then all formats run
    through the automaton, in Spark, for its probabilities, and again for the levels."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for value in batch.column(0).to_pylist():
                base = base_spans(value or "")
                seen.update((s[2], char_format(s[3])) for s in base)
                seen.update(("ordinary", f) for _, _, f in candidates(value or "", base))
            rows = [(k, f, n) for (k, f), n in seen.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.int64()))],
                ["kind", "format", "n"],
            )

    counts = documents.select(text).mapInArrow(count, "kind string, format string, n long")
    counts = stored(counts.groupBy("kind", "format").agg(F.sum("n").alias("n")), "formats")
    sizes = counts.groupBy("kind").agg(F.sum("n").alias("n"), F.sum(F.col("n") * (F.length("format") + 1)).alias("signs")).collect()
    total = {r["kind"]: r["n"] for r in sizes}
    fewest = {
        r["kind"]: max(2, -(-r["signs"] // TREE_STATES)) for r in sizes if r["kind"] == "ordinary" or r["n"] >= LEAST_LABELLED
    }
    automata = {kind: Automaton.of_tree(root) for kind, root in _trees(counts, fewest).items()}
    visits: dict[str, dict[tuple[int, str], int]] = {}
    for kind, state, sign, n in _summed(counts, _visits(automata), "kind string, state long, sign string", ["kind", "state", "sign"]):
        visits.setdefault(kind, {})[state, sign] = n
    for kind, automaton in automata.items():
        automaton.reweigh(visits[kind])
    levels: dict[tuple[str, str], list[tuple[int, int]]] = {}
    for what, kind, step, n in _summed(counts, _steps(automata), "what string, kind string, step long", ["what", "kind", "step"]):
        levels.setdefault((what, kind), []).append((step, n))
    kinds = {}
    for kind in BASE:
        if kind in automata and total[kind] >= LEAST_LABELLED:
            gains = sorted(levels.get(("gain", kind), []), reverse=True)
            margin = max(MARGIN, _level(gains, 0.001) * STEP) if gains else MARGIN
            kinds[kind] = (automata[kind], _level(sorted(levels["usual", kind]), 0.01) * STEP, margin)
    return Formats(automata.get("ordinary"), kinds)


def _summed(counts: DataFrame, rows_of, schema: str, keys: list[str]) -> list:
    """Keys with their sums of n; `rows_of(kind, format, n, into)` adds to a Counter of key tuples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64() if c.endswith("long") else pa.string() for c in schema.split(", ")]
        for batch in batches:
            into: Counter = Counter()
            for kind, form, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows_of(kind, form, n, into)
            columns = [pa.array([k[i] for k in into], t) for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(into.values()), pa.int64())], [*keys, "n"])

    return counts.mapInArrow(run, f"{schema}, n long").groupBy(*keys).agg(F.sum("n").alias("n")).collect()


def _visits(automata: dict[str, Automaton]):
    def rows_of(kind, form, n, into):
        if kind in automata:
            own: Counter = Counter()
            automata[kind].count(form, n, own)
            for (state, sign), m in own.items():
                into[kind, state, sign] += m

    return rows_of


def _steps(automata: dict[str, Automaton]):
    """Labelled formats by likelihood, ordinary ones by their gain in each kind; rounded down, so that who sets a level passes it."""

    def rows_of(kind, form, n, into):
        if kind != "ordinary":
            if kind in automata:
                into["usual", kind, math.floor(automata[kind].likelihood(form) / STEP)] += n
            return
        other = automata[kind].likelihood(form)
        for name, automaton in automata.items():
            if name != kind:
                into["gain", name, math.floor((automaton.likelihood(form) - other) / STEP)] += n

    return rows_of


def _child(key: int, sign: str) -> int:
    """Key of a state's follower, a 64-bit hash along the prefix."""
    x = ((key ^ ord(sign)) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 29)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    return x ^ (x >> 32)


def _trees(counts: DataFrame, fewest: dict[str, int]) -> dict[str, _State]:
    """Prefix trees of the kinds down to states with fewer arrivals than
    `fewest`, which are cut. Counted in Spark, some depths a pass."""
    roots = {kind: i + 1 for i, kind in enumerate(sorted(fewest))}
    nodes: dict[int, dict[str, int]] = {}
    low, high, open_ = 0, FIRST_DEPTH, set(roots.values())
    while open_:

        def states(batches: Iterator[pa.RecordBatch], low=low, high=high, open_=frozenset(open_)) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                seen: Counter = Counter()
                for kind, form, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if kind not in roots or len(form) < low:
                        continue
                    key = roots[kind]
                    for c in form[:low]:
                        key = _child(key, c)
                    if key not in open_:
                        continue
                    for c in form[low:high]:
                        seen[kind, key, c] += n
                        key = _child(key, c)
                    if len(form) < high:
                        seen[kind, key, ""] += n
                columns = [
                    pa.array([k[0] for k in seen], pa.string()),
                    pa.array([k[1] - (1 << 63) for k in seen], pa.int64()),
                    pa.array([k[2] for k in seen], pa.string()),
                    pa.array(list(seen.values()), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["kind", "key", "sign", "n"])

        signs = counts.mapInArrow(states, "kind string, key long, sign string, n long")
        signs = signs.groupBy("kind", "key", "sign").agg(F.sum("n").alias("n"))
        found = signs.groupBy("kind", "key").agg(F.sum("n").alias("arrivals"), F.collect_list(F.struct("sign", "n")).alias("signs"))
        least = F.create_map(*[F.lit(x) for pair in fewest.items() for x in pair])[F.col("kind")]
        fresh = {}
        for r in found.filter(F.col("arrivals") >= least).collect():
            fresh[r["key"] + (1 << 63)] = (r["kind"], {s["sign"]: s["n"] for s in r["signs"]})
        nodes.update({key: own for key, (_, own) in fresh.items()})
        open_ = {
            child for key, (kind, own) in fresh.items() for c, n in own.items()
            if c and n >= fewest[kind] and (child := _child(key, c)) not in nodes
        }
        low, high = high, 2 * high
    out = {}
    for kind, root in roots.items():
        out[kind] = _State()
        todo = [(out[kind], root)]
        while todo:
            state, key = todo.pop()
            own = nodes.get(key)
            if own is None:
                state.cut = True
                continue
            state.arrivals, state.ends = sum(own.values()), own.get("", 0)
            for c in sorted(own):
                if c:
                    state.counts[c] = own[c]
                    state.next[c] = _State()
                    todo.append((state.next[c], _child(key, c)))
    return out


SECRETS = "array<struct<start:long,end:long,kind:string,base:boolean,gain:double>>"


def find_secrets(documents: DataFrame, text: str = "text") -> DataFrame:
    """`documents` with `secrets`: spans in code points, by start, then kind.

    Base spans are those of the fixed patterns; added ones have kind
    `format_<kind>` and never touch a base span. Null and empty texts have none;
    copies and repeated rows get the same; an input without labelled credentials
    gets base spans only (there are none); a column named `secrets` is replaced.
    """
    spark = documents.sparkSession
    prepare(spark)
    formats = spark.sparkContext.broadcast(learn_formats(positional(documents)[0], positional(documents)[2][text]))
    carried, columns, new = positional(documents, ("secrets",))
    names = carried.columns
    at = names.index(new[text])
    kind_of = pa.list_(
        pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("base", pa.bool_()), ("gain", pa.float64())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[str, float] | None] = {}
        for batch in batches:
            rows = []
            for value in batch.column(at).to_pylist():
                base = base_spans(value or "")
                found = [{"start": s, "end": e, "kind": k, "base": True, "gain": None} for s, e, k, _ in base]
                for s, e, form in candidates(value or "", base):
                    if form not in known:
                        if len(known) > 200_000:
                            known.clear()
                        known[form] = formats.value.best(form)
                    if known[form]:
                        kind, gain = known[form]
                        found.append({"start": s, "end": e, "kind": f"format_{kind}", "base": False, "gain": gain})
                found.sort(key=lambda f: f["start"])  # stable: base kinds stay as listed
                rows.append(found)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, kind_of)], [*names, "secrets"])

    schema = ", ".join(f"{n} {t}" for n, t in carried.dtypes)
    return carried.mapInArrow(run, f"{schema}, secrets {SECRETS}").toDF(*columns, "secrets")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans in `documents`, a row per row; edge cases as in `find_secrets` (null and empty texts
    have no spans and the digest of nothing, repeated rows have a row each)."""
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("secrets", lambda s: s["base"])
    kinds = F.transform("secrets", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in BASE
    ]
    return found.select(
        "doc_id", *counts, F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.col("secrets")).alias("spans")
    )
