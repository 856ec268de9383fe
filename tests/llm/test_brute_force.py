"""Operators against plain versions of what they compute."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.llm import decontamination, language, minhash, mixing, pages, secrets, suffix_repeats, tokens, vectors
from tallymark.llm.common import components, union_find


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def test_op1_base_spans_match_the_patterns(spark, sf_dir, docs):
    rules = [
        ("assign", r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
        ("access", r"AKIA[A-Z0-9]+", 0, 20),
        ("hex", r"[0-9a-f]+", 0, 24),
    ]
    got = {r.doc_id: r for r in secrets.op1_secrets(spark, sf_dir).collect()}
    for doc, text, _ in docs:
        spans = []
        for i, (kind, pattern, group, least) in enumerate(rules):
            spans += [(m.start(), i, m.end(), kind) for m in re.finditer(pattern, text or "") if len(m.group(group)) >= least]
        line = ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))
        assert got[doc].base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert got[doc].n_hex == sum(s[3] == "hex" for s in spans)
        assert set(line.split(",")) - {""} <= set(got[doc].spans.split(","))


def test_op1_automata_find_formats_of_labelled_credentials(spark):
    rng = random.Random(3)

    def key(n):
        return "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ", k=4)) + "-" + "".join(rng.choices("0123456789", k=n))

    rows = [(i, f"secret={key(12)} and some ordinarywordsoflength{i % 7}") for i in range(200)]
    bare = key(12)
    rows.append((1000, f"left behind {bare} in a text with ordinarywordsoflength9"))
    found = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).filter("doc_id >= 1000").first()
    assert [(s.kind, s.start, s.end, s.base) for s in found.secrets] == [("format_assign", 12, 12 + len(bare), False)]


def test_op1_learns_from_all_formats(spark, monkeypatch):
    monkeypatch.setattr(secrets, "TREE_STATES", 200)  # far fewer than the formats have
    rng = random.Random(4)
    rows = [(i, "AKIA" + "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=16))) for i in range(6000)]
    rows += [(10_000 + i, "a_word_" + "".join(rng.choices("ghijklmnop", k=10 + i % 7))) for i in range(500)]
    rows.append((20_000, "token=" + "0" * 500))
    formats = secrets.learn_formats(spark.createDataFrame(rows, "doc_id long, text string"))
    mine = [formats.kinds["access"][0].likelihood(secrets.char_format(t)) for i, t in rows[:6000]]
    least = formats.kinds["access"][1]
    assert 0.95 < sum(m >= least for m in mine) / 6000 < 1.0  # whatever they begin with
    letters = [m for (i, t), m in zip(rows, mine) if not t[4:8].isdigit()]
    assert sum(m >= least for m in letters) >= 0.95 * len(letters)
    assert "assign" not in formats.kinds and len(formats.kinds["access"][0].steps) <= 200


def test_op1_state_merging_recovers_a_language():
    strings = {"ab" * k: 2048 >> k for k in range(1, 12)}  # as likely to stop after every pair
    automaton = secrets.Automaton(strings)
    assert len(automaton.steps) <= 4
    assert automaton.likelihood("abab") > automaton.likelihood("aabb") + 1


def test_op2_counts_are_the_library_s_and_come_from_the_cache(spark, sf_dir, docs, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    odd = ["a<|endoftext|>b <|ENDOFTEXT|>", "  x y \x1cz  ", "é ́x ΑΣ Σ", "it's I'LL 1234 ½", "x y z\x0b\x85w"]
    texts = [t for _, t, _ in docs] + odd + ["  x y  \x1cz"]
    plain = [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    definition, cache = open(path, encoding="utf-8").read(), str(tmp_path / "cache")
    got = {r.doc_id: r for r in tokens.count_tokens(frame, definition, cache).collect()}
    assert [got[i].n_tokens for i in range(len(texts))] == plain
    assert [got[i].n_bytes for i in range(len(texts))] == [len(t.encode()) for t in texts]
    stored = spark.read.parquet(cache).count()
    distinct = {re.sub("[ \t\r\n]+", " ", t).strip(" ") for t in texts}
    assert stored == len(distinct)
    tokens.count_tokens(frame, definition, cache).count()
    assert spark.read.parquet(cache).count() == stored  # nothing was encoded again
    # a stored count is used as it stands
    spark.read.parquet(cache).withColumn("n_tokens", F.lit(7).cast("long")).write.parquet(str(tmp_path / "other"))
    assert {r.n_tokens for r in tokens.count_tokens(frame, definition, str(tmp_path / "other")).collect()} == {7}


def plain_kneser_ney(counts, order=4):
    """Log-probability by the textbook recursion over dictionaries."""
    tables = {order: dict(counts)}
    for o in range(order - 1, 0, -1):
        tables[o] = Counter(g[1:] for g in tables[o + 1])

    def discount(t):
        one, two = sum(v == 1 for v in t.values()), sum(v == 2 for v in t.values())
        return one / (one + 2 * two) if one and two else 0.5

    def p(gram):
        if not gram:
            return 1 / 64
        t = tables[len(gram)]
        d, same = discount(t), [v for g, v in t.items() if g[:-1] == gram[:-1]]
        if not same:
            return p(gram[1:])
        return max(t.get(gram, 0) - d, 0) / sum(same) + d * len(same) / sum(same) * p(gram[1:])

    return p


def test_op3_probabilities_match_the_recursion():
    rng = random.Random(5)
    text = "".join(rng.choices("abcd", [5, 3, 2, 1], k=300))
    codes = [ord(c) - 96 for c in text]
    grams = Counter(tuple(codes[i : i + 4]) for i in range(len(codes) - 3))
    pack = {sum(c << 6 * (3 - i) for i, c in enumerate(g)): n for g, n in grams.items()}
    keys = np.array(sorted(pack))
    probability, weight, below = language.kneser_ney(keys, np.array([pack[k] for k in keys]))
    p = plain_kneser_ney(grams)
    for g in [*list(grams)[:20], (1, 2, 3, 9), (9, 9, 1, 2), (4, 4, 4, 4)]:
        key = sum(c << 6 * (3 - i) for i, c in enumerate(g))
        at = np.searchsorted(keys, key)
        mine = probability[at] if at < len(keys) and keys[at] == key else weight[key >> 6] * below[key & (1 << 18) - 1]
        assert math.isclose(mine, p(g), rel_tol=1e-9)


def test_op3_held_out_accuracy(spark, sf_dir):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = language.op3_language(spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert not any(r.rejected for r in got if r.lang_pred != "und")


def test_op3_rejects_random_letters(spark, sf_dir):
    rng = random.Random(1)
    noise = [(-i, " ".join("".join(rng.choices("qxzjkvwpbg", k=9)) for _ in range(60)), None) for i in range(1, 6)]
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    both = table.unionByName(spark.createDataFrame(noise, "doc_id long, text string, lang string"))
    kept = {r.doc_id for r in language.drop_unidentified(both).collect()}
    assert not [i for i in kept if i < 0] and len(kept) == table.count()


def test_op3_sets_a_level_for_every_language(spark, monkeypatch):
    monkeypatch.setattr(language, "CALIBRATION_TEXTS", 20)
    rng = random.Random(5)
    rows = [("big", " ".join(rng.choices(["lorem", "ipsum", "dolor", "amet"], k=20))) for _ in range(900)]
    rows += [("big", "one copied text " * 4)] * 600
    rows += [("small", " ".join(rng.choices(["kuusi", "palaa", "talo", "yksi"], k=20))) for _ in range(3)]
    model = language.learn(spark.createDataFrame(rows, "lang string, text string"))
    assert set(model.limits) == {"big", "small"}
    # without a level, what is no better than random letters is rejected all the same
    monkeypatch.setattr(language, "_calibrate", lambda *_: None)
    odd = "".join(rng.choices("bcdfghjqvwxz", k=300))
    frame = spark.createDataFrame([(*r, True) for r in rows] + [(None, odd, False)], "lang string, text string, seen boolean")
    got = language.identify(frame, F.col("seen")).filter("not seen or lang = 'small'").collect()
    assert [r.rejected for r in got] == [not r.seen for r in got]


def test_op3_levels_come_from_all_distinct_texts(spark, monkeypatch):
    rng = random.Random(6)
    words = ["lorem", "ipsum", "dolor", "amet", "elit", "sed"]
    rows = [(lang, " ".join(rng.choices(words[at:], k=rng.randint(3, 30)))) for lang, at in (("big", 0), ("mid", 3)) for _ in range(400)]
    rows += [("big", "one copied text " * 4)] * 300 + [("mid", "1 2 3")]
    frame = spark.createDataFrame(rows, "lang string, text string")
    model = language.learn(frame)
    texts = {lang: sorted({t for name, t in rows if name == lang and t != "1 2 3"}) for lang in ("big", "mid")}
    for most in (10, 100_000):  # with the tasks, and on the driver
        monkeypatch.setattr(language, "CALIBRATION_TEXTS", most)
        language._calibrate(spark, frame, model)
        for lang, own in texts.items():
            data = np.frombuffer("".join(own).encode(), np.uint8)
            keys, first, _ = language.gram_keys(data, np.concatenate([[0], np.cumsum([len(t) for t in own])]))
            e, n = model.entropies(keys, first)[:, model.languages.index(lang)], np.diff(first)
            above = np.maximum(e - np.median(e), 0)
            want = (np.median(e), np.quantile(above, 0.999), np.quantile(above * np.sqrt(n), 0.999))
            assert np.allclose(model.limits[lang], want, rtol=1e-12)


def test_op3_learns_without_rows_on_the_driver(spark, monkeypatch):
    """Counts come as columns, and levels of many texts need no global order of them."""
    from tallymark.functions import quantiles

    def refused(*_, **__):
        raise AssertionError("not needed here")

    monkeypatch.setattr(type(spark.range(0)), "toPandas", refused)
    monkeypatch.setattr(quantiles, "running_totals", refused)
    monkeypatch.setattr(language, "CALIBRATION_TEXTS", 20)
    monkeypatch.setattr(language, "LEVELS_AT_ONCE", 2)
    rng = random.Random(8)
    rows = [(name, " ".join(rng.choices(["lorem", "ipsum", "dolor", "amet"], k=12))) for name in ("a", "b", "c's") for _ in range(40)]
    model = language.learn(spark.createDataFrame(rows, "lang string, text string"))
    assert model.languages == ["a", "b", "c's"] and set(model.limits) == {"a", "b", "c's"}
    assert language.learn(spark.createDataFrame([], "lang string, text string")) is None


def test_op4_reads_articles(spark, sf_dir):
    import html

    got = {r.page_id: r for r in pages.op4_main_text(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        article = re.search("<article>(.*?)</article>", r.html, re.S).group(1).replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id].text == "\n".join(p for p in parts if p)
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


def test_op4_deduces_template_texts_and_slots(spark, monkeypatch):
    rows = []
    for i in range(12):
        rows.append((i, f"http://site.example/{i}", f"""<html><body><div id='links'><a href=/>Home</a> <a href=/x>More {i}</a></div>
            <div class=story><p>Article {i} starts here &lt;now&gt;</p><p>Follow us for more stories like this</p><p>and it goes on, {i * 7} words.</p>
            <form><p>Your mail</p></form><div class="reader-comments"><p>First! {i}</p></div></div><div class=sidebar><p>Side {i}</p></div>"""))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    wanted = {i: f"Article {i} starts here <now>\nand it goes on, {i * 7} words." for i in range(12)}
    assert {r.page_id: r.text for r in pages.extract_text(frame).collect()} == wanted
    monkeypatch.setattr(pages, "HELD_ROWS", 0)
    assert {r.page_id: r.text for r in pages.extract_text(frame).collect()} == wanted


@pytest.mark.parametrize("held", [100_000, 0])
def test_op4_keeps_all_slots_with_text(spark, monkeypatch, held):
    monkeypatch.setattr(pages, "HELD_ROWS", held)
    rows, wanted = [], {}
    for i in range(8):
        rows.append((i, f"http://site.example/{i}", f"""<html><body><div class=links><a href=/>Home</a> <a href=/x>More {i}</a></div>
            <div class=intro><p>Short {i}</p></div><div class=details><p>The long details of number {i} go on and on.</p><p><a href=/s>Source {i}</a></p>
            <ul><li><a href=/y>See {i}</a></ul></div><div class=foot><p>Same on all pages</p></div></body></html>"""))
        wanted[i] = f"Short {i}\nThe long details of number {i} go on and on.\nSource {i}\nSee {i}"
        rows.append((100 + i, f"http://other.example/{i}", f"""<html><body><div class=content><h1>Title {i}</h1><p>Lede {i}</p>
            <div class=body><p>The body of number {i} has far more text than its title.</p></div></div></body></html>"""))
        wanted[100 + i] = f"Title {i}\nLede {i}\nThe body of number {i} has far more text than its title."
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in pages.extract_text(frame).collect()} == wanted


def test_op5_targets_and_copies(spark, sf_dir, docs):
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t, _ in docs}
    total = Counter()
    for d, _, s in docs:
        total[s] += size[d]
    names = sorted(total, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    capped = set()
    while True:
        free = [s for s in names if s not in capped]
        level = (1.5 * sum(total.values()) - sum(2 * total[s] for s in capped)) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * total[s]}
        if not over:
            break
        capped |= over
    got = mixing.op5_mixing(spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.op5_mixing(spark, sf_dir).collect()))
    taken, longest = Counter(), Counter()
    for r in got:
        source = next(s for d, _, s in docs if d == r.doc_id)
        assert r.size == size[r.doc_id] and r.source_size == total[source] and r.taken in (0, r.size, 2 * r.size)
        assert math.isclose(r.target, 2 * total[source] if source in capped else level * weight[source], rel_tol=1e-9)
        taken[source] += r.taken
        longest[source] = max(longest[source], r.size)
    for s in names:
        target = 2 * total[s] if s in capped else level * weight[s]
        assert abs(taken[s] - target) <= longest[s]


def test_op5_tree_keeps_the_sum(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAN", 4)
    rows = [(i, "w " * (1 + i % 9), "s" if i % 3 else "t") for i in range(300)]
    got = mixing.mix_copies(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == 300 and len({r.doc_id for r in got}) == 300
    for s in "st":
        own = [r for r in got if r.source == s]
        assert abs(sum(r.size * r.copies for r in own) - own[0].target) <= 9


def test_op6_round_trip_and_fit(spark, sf_dir, docs):
    words = tokens.WordIds(*tokens.packing_vocabulary())
    rows = tokens.op6_packed_ids(spark, sf_dir).collect()
    parts = defaultdict(dict)
    for r in rows:
        ids = np.frombuffer(r.input_ids, "<u2")
        assert len(ids) == 2048 and (ids[r.n_tokens :] == tokens.PAD).all() and r.cu_seqlens[-1] == r.n_tokens
        assert r.position_resets == r.cu_seqlens[:-1] and r.cu_seqlens[0] == 0
        for k, (doc, at) in enumerate(zip(r.doc_ids, r.doc_offsets)):
            parts[doc][at] = ids[r.cu_seqlens[k] : r.cu_seqlens[k + 1]]
    for doc, text, _ in docs:
        ids = np.concatenate([v for _, v in sorted(parts[doc].items())]).tolist() if text else []
        assert words.encoding.decode(ids) == (text or "") and ids == words.encoding.encode_ordinary(text or "")
    assert sum(r.n_tokens for r in rows) > 0.9 * 2048 * len(rows)


def test_op6_best_fit_is_what_a_scan_finds():
    rng = random.Random(2)
    lengths = [rng.randint(1, 64) for _ in range(400)]
    free, bins = [], []
    for i in sorted(range(400), key=lambda i: -lengths[i]):
        fits = [(f, -b) for b, f in enumerate(free) if f >= lengths[i]]
        if fits:
            f, b = min(fits)
            free[-b] -= lengths[i]
            bins[-b].append(i)
        else:
            free.append(64 - lengths[i])
            bins.append([i])
    mine = tokens.best_fit_decreasing(lengths, 64)
    assert sorted(i for b in mine for i in b) == list(range(400)) and len(mine) == len(bins)
    assert all(sum(lengths[i] for i in b) <= 64 for b in mine)


def test_op7_links_against_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 16))
    x = np.concatenate([b + 0.22 * rng.normal(size=(n, 16)) for b, n in zip(base, rng.integers(1, 60, 40))])
    x = np.concatenate([x, x[:50], rng.normal(size=(300, 16))])
    frame = spark.createDataFrame([(int(i) * 3, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in vectors.near_vectors(frame).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    true = near.sum(axis=1) - 1
    mine = np.array([got[3 * i].n_links for i in range(len(x))])
    assert (mine <= true).all() and mine.sum() >= 0.97 * true.sum()
    root = union_find(len(x), *np.nonzero(near))
    agree = sum(got[3 * i].component_id == 3 * root[i] for i in range(len(x)))
    assert agree >= 0.97 * len(x)


def test_op7_blocks_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 32)
    rng = np.random.default_rng(6)
    x = rng.normal(size=8) + 0.02 * rng.normal(size=(200, 8))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = vectors.near_vectors(frame).collect()
    assert {r.component_id for r in got} == {0} and sum(r.n_links for r in got) >= 0.97 * 200 * 199


def test_op7_links_count_at_both_ends(spark, monkeypatch):
    monkeypatch.setattr(vectors, "PER_CENTROID", 8)
    monkeypatch.setattr(vectors, "_audit", lambda *_: 1.0)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(60, 6))[rng.integers(60, size=240)] + 0.12 * rng.normal(size=(240, 6))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in vectors.near_vectors(frame, overlap=2).collect()}
    alone = {}
    for r in got.values():
        alone.setdefault(r.component_id, []).append(r.n_links)
    # every found link has two ends, so no member of a component is without one and pairs agree
    assert all(min(n) >= 1 for n in alone.values() if len(n) > 1)
    assert all(n == [1, 1] for n in alone.values() if len(n) == 2)
    assert sum(r.n_links for r in got.values()) % 2 == 0


def test_op7_audit_is_not_hidden_by_a_large_group():
    assert vectors._recall([(5000, 5000)] * 40 + [(1, 0)] * 20 + [(1, 1)] * 20) == 0.5
    assert vectors._recall([(0, 0)]) == 1.0 and vectors._recall([(4, 4), (5000, 5000)]) == 1.0


@pytest.mark.parametrize("task_runs", [256, 1])
def test_op8_against_a_count_of_all_strings(spark, sf_dir, docs, task_runs, monkeypatch):
    monkeypatch.setattr(suffix_repeats, "TASK_RUNS", task_runs)
    got = {r.doc_id: r for r in suffix_repeats.op8_suffix_repeats(spark, sf_dir).collect()}
    count = Counter()
    for _, t, _ in docs:
        b = (t or "").encode()
        count.update(hash(b[i : i + 200]) for i in range(len(b) - 199))
    for doc, t, _ in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if count[hash(b[i : i + 200])] > 1:
                gone[i : i + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(b, gone) if not g)
        r = got[doc]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_op8_rows_of_a_passage_in_many_surroundings_are_linear(spark, monkeypatch):
    """Also where a string has as many runs as documents; each level keeps a few of each."""
    rng = random.Random(10)
    passage = "".join(rng.choices("abcdefgh ", k=330))
    rows = [(i, "".join(rng.choices("ijklmnop ", k=150)) + passage + "".join(rng.choices("qrstuv ", k=150))) for i in range(60)]
    monkeypatch.setattr(suffix_repeats, "TASK_RUNS", 8)
    sizes = []
    wanted = suffix_repeats._wanted

    def counting(folded, *item):
        out = wanted(folded, *item)
        sizes.append(out.select(F.sum(F.size("wanted"))).first()[0])
        return out

    monkeypatch.setattr(suffix_repeats, "_wanted", counting)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    count, first = Counter(), {}
    for doc, t in rows:
        for i in range(len(t) - 199):
            count[t[i : i + 200]] += 1
            first.setdefault(t[i : i + 200], (doc, i))
    for keep_first in (True, False):
        sizes.clear()
        for r in suffix_repeats.repeated_passages(frame, keep_first).collect():
            gone = bytearray(len(r.text))
            for i in range(len(r.text) - 199):
                window = r.text[i : i + 200]
                if count[window] > 1 and not (keep_first and first[window] == (r.doc_id, i)):
                    gone[i : i + 200] = b"\1" * 200
            assert r.kept == bytes(x for x, g in zip(r.text.encode(), gone) if not g)
        assert len(sizes) == len(suffix_repeats.levels(200)) and max(sizes) <= 8 * len(rows)


@pytest.mark.parametrize("task_runs", [256, 1])
@pytest.mark.parametrize("unit", ["a", "ab", "x" * 199 + "y"])
def test_op8_periodic_texts(spark, unit, task_runs, monkeypatch):
    monkeypatch.setattr(suffix_repeats, "TASK_RUNS", task_runs)
    rows = [(1, (unit * 900)[:700]), (2, unit * 2), (3, "z" + (unit * 900)[:450])]
    count = Counter()
    for _, t in rows:
        count.update(t[i : i + 200] for i in range(len(t) - 199))
    for r in suffix_repeats.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), False).collect():
        gone = bytearray(len(r.text))
        for i in range(len(r.text) - 199):
            if count[r.text[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        assert r.kept == bytes(x for x, g in zip(r.text.encode(), gone) if not g)


def test_op8_first_copies_stay(spark):
    rng = random.Random(9)
    passage = "".join(rng.choices("abcdefgh ", k=900))
    rows = [(i, "".join(rng.choices("ijklmnop ", k=50 + i)) + passage[i * 40 : i * 40 + 500] + "".join(rng.choices("qrstuv ", k=99))) for i in range(9)]
    got = suffix_repeats.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    first = {}
    for doc, t in rows:
        for i in range(len(t) - 199):
            first.setdefault(t[i : i + 200], (doc, i))
    for r in got:
        gone = bytearray(len(r.text))
        for i in range(len(r.text) - 199):
            if first[r.text[i : i + 200]] != (r.doc_id, i):
                gone[i : i + 200] = b"\1" * 200
        assert r.kept == bytes(x for x, g in zip(r.text.encode(), gone) if not g)


def test_op8_longest_previous_factor():
    text = b"abracadabra" * 2 + b"$" * 11
    keys = [text[i : i + 11] for i in range(22)]
    previous, best = suffix_repeats.longest_previous_factor(keys, np.arange(22))
    for i in range(22):
        common = [next((n for n in range(11) if keys[i][n] != keys[j][n]), 11) for j in range(22)]
        assert previous[i] == max(common[:i], default=0) and best[i] == max(common[:i] + common[i + 1 :])


def sets_of(docs, width):
    out = {}
    for doc, text, _ in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        out[doc] = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    return out


@pytest.mark.parametrize("block", [1024, 2])
def test_op9_components_against_all_pairs(spark, sf_dir, docs, block, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", block)
    got = {r.doc_id: r for r in minhash.op9_minhash(spark, sf_dir).collect()}
    sets = sets_of(docs, 2)
    ids = sorted(sets)
    a, b = [], []
    for i, j in combinations(range(len(ids)), 2):
        s, t = sets[ids[i]], sets[ids[j]]
        if s and t and 100 * len(s & t) >= 80 * len(s | t):
            a.append(i)
            b.append(j)
    root = union_find(len(ids), np.array(a, int), np.array(b, int))
    assert len(a) > 5
    for i, doc in enumerate(ids):
        r = got[doc]
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[doc]), ids[root[i]], root[i] == i)


def test_op9_odd_sketch_estimates_high_similarity():
    rng = np.random.default_rng(8)
    common = rng.integers(0, 1 << 63, 900).astype(np.uint64)
    sets = [np.unique(np.append(common, rng.integers(0, 1 << 63, 112).astype(np.uint64))) for _ in range(60)]
    _, sketch = minhash._signatures(sets)
    rows = sketch.view(np.uint64)
    odd = [int(np.bitwise_count(rows[i] ^ rows[j]).sum()) for i, j in combinations(range(60), 2)]
    assert max(odd) <= minhash.MOST_ODD and 25 < np.mean(odd) < 46  # similarity 0.8: 36


def test_op10_against_all_windows(spark, sf_dir, docs):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))

    windows = defaultdict(set)
    for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        w = words(r.text)
        n = min(13, len(w))
        for j in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[j : j + n])].add(str(r.item_id))
    got = {r.doc_id: r for r in decontamination.op10_decontamination(spark, sf_dir).collect()}
    for doc, text, _ in docs:
        w, hit, items = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for p in range(len(w) - n + 1):
                if own := windows.get(tuple(w[p : p + n])):
                    hit.update(range(p, p + n))
                    items |= own
        r = got[doc]
        assert (r.n_words, r.n_hit, r.n_items) == (len(w), len(hit), len(items))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))


def test_op10_longest_matches_and_places(spark):
    item = " ".join(f"w{i}" for i in range(30))
    text = "Before it all, " + item.upper() + " after. " + " ".join(f"w{i}" for i in range(3, 18)) + " short w1 w2"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    bench = spark.createDataFrame([("x", item), ("tiny", "short w1")], "item_id string, text string")
    got = decontamination.find_matches(docs, bench).first().matches
    assert sorted(tuple(m) for m in got) == [("tiny", 0, 49, 2), ("x", 0, 3, 30), ("x", 3, 34, 15)]


def test_components_of_stars_take_no_round(spark, monkeypatch):
    from tallymark.llm import common

    written, whole = [], common.stored
    monkeypatch.setattr(common, "stored", lambda df, label: written.append(label) or whole(df, label))
    for links, rounds in (([(1, 5), (7, 1), (1, 5), (5, 1), (3, 3), (8, 9)], 0), ([(1, 5), (5, 9)], 1), ([], 0)):
        written.clear()
        got = sorted(tuple(r) for r in common.components(spark.createDataFrame(links, "a long, b long")).collect())
        ids = sorted({x for pair in links if pair[0] != pair[1] for x in pair})
        assert got == [(x, 8 if x in (8, 9) and rounds == 0 else 1) for x in ids]
        assert written == ["links"] * (1 + rounds)


def test_components_of_a_chain_and_a_star(spark):
    rng = random.Random(0)
    links = [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 280)]
    rng.shuffle(links)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 200 for i in range(200, 280)}}
