"""Repair of conversations and their prefix trie against plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from tallymark.llm import conversations, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
def random_turns(seed, long=60):
    rng = random.Random(seed)
    rows = []
    for c in range(12):
        n = long if c == 3 else rng.randrange(0, 9)
        for i in range(n):
            turn = rng.choice([None, i, i, i, 2 * i])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = rng.choice(["", " ", None, "yes.", "no", "what?", f"text {rng.randrange(40)}.", f"open {rng.randrange(40)} "])
            rows.append((c, turn, role, text))
    return rows


def prepared(rows):
    """Rows per conversation, ordered as the operator states."""
    by = defaultdict(list)
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        digest = hashlib.md5(f"{len(role)}:{role}:{text}".encode()).digest()
        by[c].append(((turn is not None, turn or 0), digest, turn, role, text))
    return {c: [(t, r, x) for _, _, t, r, x in sorted(v, key=lambda v: v[:2])] for c, v in by.items()}


def plain_repair(rows):
    """Cheapest audit and its repaired lines, by search over all positions and states."""
    seen, faults = set(), []
    for _, role, text in rows:
        said = [ch for ch in text if ch not in " \t\n\v\f\r"]
        fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    kept = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @lru_cache(None)
    def best(i, state, put):
        """(cost, audit, lines); at most two turns are put in at one place."""
        options = []
        if i == len(rows) and state in ("", "a"):
            options.append((0, "", ()))
        other = "a" if state == "u" else "u"
        name = {"u": "user", "a": "assistant"}[other]
        if put < 2:
            cost, audit, lines = best(i, other, put + 1)
            options.append((cost + 3, "I" + audit, (name + ":",) + lines))
        if i < len(rows):
            cost, audit, lines = best(i + 1, state, 0)
            options.append((cost + 4, "D" + audit, lines))
            if faults[i] not in ("blank", "duplicate"):
                _, role, text = rows[i]
                more = 3 if faults[i] == "truncated" else 0
                cost, audit, lines = best(i + 1, other, 0)
                options.append((cost + 3 + more, "R" + audit, (f"{name}:{text}",) + lines))
                to = kept.get((state, role[:1]))
                if to:
                    cost, audit, lines = best(i + 1, to, 0)
                    options.append((cost + more, "K" + audit, (f"{role}:{text}",) + lines))
        return min(options) if options else (10**9, "", ())

    cost, audit, lines = best(0, "", 0)
    known = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return {
        "gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0,
        **{k: faults.count(k) for k in ("blank", "duplicate", "truncated")},
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs),
        "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }, lines


@pytest.mark.parametrize("piece_rows", [1, 4, 65_536])
def test_repair_agrees_with_search(spark, piece_rows):
    """Also with conversations cut into many pieces, where vectors converge after fix-up passes."""
    rows = random_turns(5)
    frame = spark.createDataFrame(rows, SCHEMA).select("*", F.lit(1).alias("KEY"), F.lit("x").alias("Text"))
    wanted = {c: plain_repair(v)[0] for c, v in prepared(rows).items()}
    renamed = frame.toDF(*SCHEMA_NAMES, "other", "more")
    got = conversations.repair_audit(renamed, piece_rows).collect()
    assert len(got) == len(wanted)
    assert {int(r.key[1:]): {k: r[k] for k in wanted[0 if 0 in wanted else 3]} for r in got} == wanted


SCHEMA_NAMES = ["conv_id", "turn", "role", "text"]


def test_repaired_turns_are_well_formed(spark):
    rows = random_turns(8)
    got = conversations.repair_conversations(spark.createDataFrame(rows, SCHEMA), 8).collect()
    by = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.conv_id, r.position)):
        by[r.conv_id].append(r)
    for c, v in prepared(rows).items():
        lines = plain_repair(v)[1]
        assert tuple(f"{r.role}:{r.text}" for r in by[c]) == lines
        assert [r.position for r in by[c]] == list(range(1, len(lines) + 1))


def test_fixup_passes_stop_where_vectors_agree():
    costs = conversations.Costs()
    a, b = conversations.END, (3, 0, 0, 6)
    kinds = [1, 2] * 6
    steps = 0
    while a != b:
        a, b, steps = costs.before(a, kinds[-1 - steps]), costs.before(b, kinds[-1 - steps]), steps + 1
    assert 0 < steps < len(kinds)


def test_repair_on_edge_rows(spark):
    rows = [(None, None, None, None), (1, None, "user", "hi."), (1, None, "user", "hi."), (2, 0, "assistant", "x" * 200_000 + "."), (2, 2**62, "user", "?")]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r.conv_id: (r.edit, r.role) for r in conversations.repair_conversations(frame).collect() if r.position == 1}
    assert got == {1: ("K", "user"), 2: ("I", "user")}
    empty = frame.limit(0)
    assert conversations.repair_conversations(empty).collect() == [] and conversations.repair_audit(empty).collect() == []
    assert conversations.damage(empty).collect() == []


def test_damage_by_checksum(spark):
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(40) for t in range(6)]
    got = Counter((r.conv_id, r.turn, r.role, r.text) for r in conversations.damage(spark.createDataFrame(rows, SCHEMA)).collect())
    wanted = Counter()
    for c, t, role, text in rows:
        fault = zlib.crc32(f"{c}:{t}".encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = "One Two Three"
        wanted[c, t, "user" if fault == 4 else role, text] += {0: 0, 3: 2}.get(fault, 1)
    assert got == +wanted


def plain_trie(sequences):
    """Nodes by prefix, from sequences of (digest, chars) per conversation."""
    members = defaultdict(list)
    chars = {(): 0}
    for c, seq in sequences.items():
        for d in range(len(seq) + 1):
            members[tuple(s[0] for s in seq[:d])].append(c)
            chars[tuple(s[0] for s in seq[:d])] = seq[d - 1][1] if d else 0
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * chars[p]
    ends = defaultdict(list)
    for c, seq in sequences.items():
        ends[tuple(s[0] for s in seq)].append(c)
    return Counter(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


TRIE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@pytest.mark.parametrize("span", [1, 2, 16])
def test_trie_agrees_with_plain_version(spark, span):
    rng = random.Random(11)
    rows = []
    for c in list(range(0, 60)) + [100, 101, 199, 205, 5000, 5001]:
        for i in range(37 if c in (100, 7, 8) else rng.randrange(1, 8)):
            rows.append((c, rng.choice([None, i, i]), rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None, "long text"])))
    by = defaultdict(list)
    for c, turn, role, text in rows:
        role, text = role or "", text or ""
        digest = hashlib.md5(f"{len(role)}:{role}:{text}".encode()).digest()
        by[c].append(((turn is not None, turn or 0), digest, len(text)))
    own = {c: [x[1:] for x in sorted(v)] for c, v in by.items()}
    sequences = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        sequences[c] = own.get(c - c % 100, [])[:h] + seq[h:]
    frame = spark.createDataFrame([*rows, (None, 1, "user", "x")], SCHEMA)
    got = prefix_trie.rebuilt_trie(frame, span).collect()
    assert Counter(tuple(r[k] for k in TRIE) for r in got) == plain_trie(sequences)


def test_trie_on_edge_rows(spark):
    rows = [(1, 0, None, None), (1, 0, None, None), (2, 0, None, None), (3, None, "user", "x" * 100_000), (None, 0, "user", "a")]
    frame = spark.createDataFrame(rows, SCHEMA).select("*", F.lit(1).alias("DEPTH"), F.lit(1).alias("node"))
    got = {(r.conv_id, r.depth): (r.n_convs, r.n_children, r.n_leaves) for r in prefix_trie.conversation_trie(frame).collect()}
    assert got == {(1, 0): (3, 2, 2), (1, 1): (2, 1, 1), (1, 2): (1, 0, 1), (3, 1): (1, 0, 1)}
    assert prefix_trie.conversation_trie(frame.limit(0)).collect() == []
    assert prefix_trie.rebuilt_trie(frame.limit(0)).collect() == []
