"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallymark.llm import decontamination, language, minhash, mixing, pages, secrets, suffix_repeats, tokens, vectors

LONG = "a fairly ordinary sentence that goes on with words number %d and then some more of them "
ROWS = [
    (1, None, "en", "a"),
    (2, "", "en", "b"),
    (3, " \t\n ", None, None),
    (4, "one", "en", "a"),
    (5, "one", "fr", "a"),
    (5, "one", "fr", "a"),
    (None, "one two three four five six seven", None, "b"),
    (6, "".join(LONG % i for i in range(3000)), "en", "a"),
    (7, "".join(LONG % i for i in range(3000)), "en", None),
    (8, 'token = "0123456789abcdef0123456789abcdef01234567" é 漢字 \U0001f600', "de", "c"),
]
NAMES = "doc_id long, text string, lang string, source string"
CLASHING = (
    "Text", "id", "text_key", "n_words", "spans", "kept", "secrets", "score", "_key", "_k", "copies", "n_bytes", "c0", "stratum"
)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, NAMES)


@pytest.fixture(scope="module")
def clashing(docs):
    out = docs
    return out.select("*", *[F.lit("x").alias(c) for c in CLASHING])


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(
        [(1, None), (2, ""), (3, "one"), (None, "one two"), (4, (LONG % 7) * 2), (4, (LONG % 7) * 2)], "item_id long, text string"
    )


def operators(spark, benchmark, tmp):
    vocabulary = tokens.packing_vocabulary()
    import public_tokenizers

    definition = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
    return {
        "secrets": secrets.find_secrets,
        "counts": lambda d: tokens.count_tokens(d, definition, tmp),
        "language": lambda d: language.identify(d, ~language.held_out()),
        "identified": language.drop_unidentified,
        "mixing": mixing.mix_copies,
        "mixed": mixing.mix_documents,
        "packing": lambda d: tokens.pack_documents(d, *vocabulary),
        "repeats": suffix_repeats.repeated_passages,
        "near": minhash.near_duplicates,
        "near_dropped": minhash.drop_near_duplicates,
        "matches": lambda d: decontamination.find_matches(d, benchmark),
        "decontaminated": lambda d: decontamination.remove_contaminated(d, benchmark),
    }


NAMES_OF = (
    "secrets", "counts", "language", "identified", "mixing", "mixed", "packing", "repeats", "near", "near_dropped", "matches",
    "decontaminated",
)
FILTERS = ("identified", "mixed", "near_dropped", "decontaminated")


@pytest.mark.parametrize("name", NAMES_OF)
def test_edge_rows(spark, docs, clashing, empty, benchmark, tmp_path, name):
    operator = operators(spark, benchmark, str(tmp_path / "cache"))[name]
    got = operator(docs).collect()
    again = operator(clashing)
    if name in FILTERS:
        assert again.columns == clashing.columns
    assert len(again.collect()) == len(got)
    assert operator(empty).collect() == []
    if name not in (*FILTERS, "packing"):
        assert len(got) == len(ROWS)
    by_id = {}
    for r in got:
        if "doc_id" in r:
            by_id.setdefault(r.doc_id, []).append(r)
    if name == "counts":
        assert [by_id[i][0].n_tokens for i in (1, 2, 3, 4)] == [0, 0, 0, 1] and by_id[1][0].n_bytes == 0
    if name == "language":
        assert [by_id[i][0].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and all(0 <= r.score <= 1 for r in got)
    if name == "secrets":
        assert [(s.kind, s.start) for s in by_id[8][0].secrets] == [("assign", 0), ("hex", 9)] and not by_id[1][0].secrets
    if name == "near":
        assert {r.component_id for r in by_id[4] + by_id[5]} == {4} and by_id[1][0].component_id == 1
        assert by_id[7][0].component_id == 6 and by_id[None][0].component_id is None
    if name == "near_dropped":
        assert Counter(r.doc_id for r in got) == Counter([1, 2, 3, 4, None, 6, 8])
    if name == "repeats":
        assert by_id[6][0].kept and by_id[7][0].kept == b"" and not by_id[1][0].spans
    if name == "matches":
        assert by_id[4][0].n_hit == 1 and by_id[None][0].n_hit == 2 and by_id[1][0].n_words == 0
    if name == "mixing":
        size = {r.source: r.source_size for r in got}
        taken = Counter()
        for r in got:
            taken[r.source] += r.size * r.copies
        assert all(r.copies in (0, 1, 2) for r in got) and taken["c"] <= 2 * size["c"]


def test_near_duplicates_stay_where_only_ids_are_shared_or_missing(spark):
    def words(a):
        return " ".join(f"w{a}x{i}" for i in range(30))

    rows = [(None, words(1)), (None, words(2)), (None, words(2) + " "), (4, words(3)), (4, words(4)), (5, words(4)), (None, None)]
    got = minhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    kept = Counter((r.doc_id, r.text and r.text.strip()) for r in got)
    assert kept == Counter([(None, words(1)), (None, words(2)), (4, words(3)), (4, words(4)), (None, None)])


def test_pages_on_edge_rows(spark):
    rows = [(1, None, None), (2, "http://a.example/x", ""), (3, "nonsense", "<p>One &amp; two<p>three"), (3, "nonsense", "<p>One &amp; two<p>three")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").select("*", F.lit(1).alias("TEXT"))
    got = pages.extract_text(frame)
    assert got.columns == ["page_id", "url", "html", "TEXT", "text"]
    assert [r[4] for r in sorted(got.collect(), key=lambda r: r[0])] == ["", "", "One & two\nthree", "One & two\nthree"]
    assert pages.extract_text(frame.limit(0)).collect() == []


def test_vectors_on_edge_rows(spark):
    nan = float("nan")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [1.0, 0.0]), (7, [2.0, 0.0]), (7, [2.0, 0.0]),
        (8, [1e300, 1e299]), (9, [0.0, 1.0]), (None, [1.0, 0.0]), (10, [1.0, 0.0, 0.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("*", F.lit(0).alias("Embedding"), F.lit(0).alias("key"))
    got = vectors.near_vectors(frame).collect()
    assert len(got) == len(rows)
    links = {r.vec_id: r.n_links for r in got}
    assert links == {1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 6: 4, 7: 4, 8: 4, 9: 0, None: 4, 10: 0}
    assert {r.component_id for r in got if r.n_links} == {6}
    assert vectors.near_vectors(frame.limit(0)).collect() == []


def test_pipeline_runs_over_all_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near-duplicates", "decontamination", "mixing", "packing"]
    packed = corpus_pipeline.run(spark, sf_dir)
    stage = docs
    for _, work in corpus_pipeline.STAGES[:-1]:
        stage = work(spark, stage, sf_dir)
        assert stage.columns == docs.columns
    wanted = Counter(r.doc_id for r in stage.select("doc_id").collect())
    starts = Counter(d for r in packed.collect() for d, at in zip(r.doc_ids, r.doc_offsets) if at == 0)
    assert starts == wanted
