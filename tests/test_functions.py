"""Functions and operators against small cases with known answers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from docmill.functions import hashing, text
from docmill.functions.records import as_list, json_array, json_object
from docmill.operators import candidates as cand
from docmill.operators import chunking, dataset, review, semantics, statistics, vectors


def values(spark, inputs, column, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


def numbers(spark, xs):
    return spark.createDataFrame([(None if x is None else float(x),) for x in xs], "v double")


def test_sentences_cut_at_any_white_space(spark):
    assert values(spark, ["Eins. Zwei! Drei? Vier.Fünf", "", None], text.sentences) == [["Eins.", "Zwei!", "Drei?", "Vier.Fünf"], [], None]


def test_block_types(spark):
    cases = {
        "2.1 Wärme": "heading", "1. Intro": "paragraph", "KAPITEL EINS": "heading", "Kapitel 3: x": "heading", "AB": "paragraph", "a  b  c": "table",
        "x | y": "table", "q = h A": "formula", "see Equation below": "formula", "plain text": "paragraph",
    }
    assert values(spark, list(cases), text.block_type) == list(cases.values())


def test_ids(spark):
    assert values(spark, ["GT/Workshop1/slides.pdf"], hashing.document_id) == ["pdf_GT__Workshop1__slides_31041ae2"]
    assert values(spark, [7, 12345], lambda i: hashing.chunk_id(F.lit("d"), i), "int") == ["d_c0007", "d_c12345"]
    assert values(spark, [7, 123456], lambda i: hashing.sequential_id("ws", i), "int") == ["ws_00007_q1", "ws_123456_q1"]
    assert values(spark, ["c"], lambda a: hashing.candidate_id(a, F.lit("What is h?"), F.lit("A coefficient."), F.lit(0))) == ["c:2cf7d49919445c8e"]
    assert values(spark, [" Q one? "], lambda q: hashing.fingerprint(q, F.lit("A one."))) == ["31eaf8760e77e8dc"]
    assert values(spark, ["doc_c0000", "doc_c0001", "doc_c0002"], lambda a: hashing.shard_of(16, a, F.lit(None), F.lit(None))) == [1, 2, 9]
    assert values(spark, ["a_b_c0001", "x"], text.chunk_document) == ["a_b", ""]


def test_slug_and_language(spark):
    assert values(spark, [" GT-Power / Füße "], text.slug) == ["gt_power_f_e"]
    assert values(spark, ["für über", "the and of to", "the and"], text.detect_language) == ["de", "en", "unknown"]


def test_structural_modes_and_leaks(spark):
    inputs = ["12.4.2", ".", "Figure 3.1 shows a long result", "Normal content", None]
    assert values(spark, inputs, text.structural_mode) == ["structural_rule1_numeric", "structural_rule1_short", "structural_rule1_label", None, "structural_rule1_short"]
    assert values(spark, ["Where is heat lost?", "Was ist h?", None], text.has_meta_leak) == [True, False, False]


def test_source_labels(spark):
    df = spark.createDataFrame([("T", None, 4, 4), ("T", None, 4, 6), ("T", None, None, None), (None, "a/b.pdf", None, None), (None, None, None, None)], "t string, p string, s int, e int")
    assert [r[0] for r in df.select(text.source_label(F.col("t"), F.col("p"), F.col("s"), F.col("e"))).collect()] == ["T — p. 5", "T — p. 5–7", "T", "b", "Unknown source"]


def test_json_inside_prose(spark):
    assert values(spark, ['a {"x":1} b', "[1]", "{bad"], lambda c: F.try_variant_get(json_object(c), "$.x", "int")) == [1, None, None]
    assert values(spark, ["a [1,2] b", "{}"], lambda c: F.try_variant_get(json_array(c), "$[1]", "int")) == [2, None]
    assert values(spark, ['{"f":"s"}', '{"f":["a","b"]}', '{"f":null}', "{}"], lambda c: as_list(F.parse_json(c), "$.f")) == [["s"], ["a", "b"], [], []]


def test_statistics(spark):
    assert numbers(spark, [1, 2, 3, 4]).agg(F.percentile("v", 0.9)).first()[0] == pytest.approx(3.7)
    assert statistics.gini(numbers(spark, [1, 2, 3, 4]), "v").first()[0] == pytest.approx(0.25)
    assert statistics.gini(numbers(spark, [0, 0]), "v").first()[0] == 0.0
    assert statistics.gini(numbers(spark, [1, 2, 3, 4, -5, None]), "v").first()[0] == pytest.approx(0.25)
    assert statistics.gini(numbers(spark, []), "v").first()[0] == 0.0
    assert {round(r["share"], 6) for r in statistics.pareto_shares(numbers(spark, [10, 5, 3, 1, 1]), "v").collect()} == {0.5}
    assert statistics.nearest_ranks(numbers(spark, [10, 20, 30, 40, 50, 60]), "v", (0.9,)).first()["value"] == 50.0


def test_chunks(spark):
    def ranges(lengths, headings=(), max_chars=20, min_chars=0, overlap=1):
        return chunking.chunk_ranges(np.array(lengths), np.isin(np.arange(len(lengths)), headings), max_chars, min_chars, overlap)

    assert ranges([]) == [] and ranges([10]) == [(0, 1, 0, 0)] and ranges([30]) == [(0, 1, 0, 0)]
    # Nothing fits beside anything: what is carried over stands alone once more.
    assert ranges([10, 10, 10]) == [(0, 1, 0, 0), (0, 1, 0, 0), (1, 2, 0, 0), (1, 2, 0, 0), (2, 3, 0, 0)]
    assert ranges([10, 10, 10], min_chars=400)[-1] == (1, 2, 2, 3)
    assert ranges([5, 5, 5, 5, 5]) == [(0, 3, 0, 0), (2, 5, 0, 0)] and ranges([5] * 5, overlap=0) == [(0, 3, 0, 0), (3, 5, 0, 0)]
    # A heading opens a chunk; a long unit stands alone; a long heading after other units opens one too and is carried nowhere.
    assert ranges([5, 5, 5], [1]) == [(0, 1, 0, 0), (1, 3, 0, 0)] and ranges([5, 25, 5]) == [(0, 1, 0, 0), (1, 2, 0, 0), (2, 3, 0, 0)]
    assert ranges([5, 25, 5], [1]) == [(0, 1, 0, 0), (1, 2, 0, 0), (2, 3, 0, 0)] and ranges([25, 5], [0]) == [(0, 1, 0, 0), (1, 2, 0, 0)]
    assert ranges([5, 5], [1]) == [(0, 1, 0, 0), (1, 2, 0, 0)]
    df = spark.createDataFrame([("d", ["Text one.\n2 Head\nText two."]), ("empty", []), ("none", None)], "doc_id string, pages array<string>")
    made = chunking.chunk_documents(df).collect()
    assert [(r["doc_id"], r["content"], r["block_types"]) for r in made] == [("d", "Text one. 2 Head Text two.", ["heading", "paragraph"])]


def test_every_line_boundary_parts_lines(spark):
    marks = ["\n", "\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029"]
    df = spark.createDataFrame([("".join(f"a{m}" for m in marks) + "a",)], "t string")
    assert df.select(F.size(chunking.lines_of(F.col("t")))).first()[0] == len("".join(f"a{m}" for m in marks).splitlines()) + 1


def test_running_lines(spark):
    pages = [("d", i, ("HDR\n" if i < 3 else f"x{i}\n") + f"body {i}\nmore {i}\nlast {i}\nHDR") for i in range(5)] + [("e", i, "HDR\nsame") for i in range(2)]
    df = spark.createDataFrame(pages, "doc_id string, page_idx int, text string")
    cleaned = {(r["doc_id"], r["page_idx"]): r["text"] for r in chunking.remove_running_lines(df).collect()}
    assert all("HDR" not in cleaned["d", i] for i in range(5)) and cleaned["e", 0] == "HDR\nsame"


def test_caps_evidence_plans(spark):
    df = spark.createDataFrame([("a", "x" * 2000)] * 150 + [("b", "")] * 10, "doc_id string, content string")
    assert {r["doc"]: r["cap"] for r in cand.adaptive_caps(df).collect()} == {"a": 72, "b": 20}
    context = F.array(F.lit("a"), F.lit("b"))
    assert values(spark, [["x"], ["b", "x"], None], lambda e: cand.evidence_ids(e, context), "array<string>") == [["a", "b"], ["b"], ["a", "b"]]
    one = '[{"takeaways":[{"takeaway":"t","evidence_chunks":[]}]}]'
    plans = values(spark, ["[]", one, "{}"], cand.valid_plan)
    assert plans[0] is not None and plans[1:] == [None, None]


def test_context_groups(spark):
    names = [f"n{i}" for i in range(15)]
    sizes = values(spark, [names], lambda n: F.transform(vectors.context_groups(F.array(F.lit("a"), F.lit("l"), F.lit("r")), n), F.size), "array<string>")[0]
    assert sizes == [10, 10, 4]
    assert values(spark, [[]], lambda n: vectors.context_groups(F.array(F.lit("a")), n, least=2, most=6), "array<string>") == [[]]
    assert values(spark, [["n1", "a"]], lambda n: vectors.context_groups(F.array(F.lit("a")), n, least=2, most=2), "array<string>") == [[["a", "n1"]]]


def test_reject_reasons(spark):
    kind = "id string, question string, answer string, language string, trust_level string, content_type array<string>, source_chunks array<string>"
    long = "An answer that is long enough to pass."
    rows = [("a", "short", long, "fr", None, None, ["x"]), ("b", "A question long enough?", long, None, None, None, ["x"]), ("c", "A question long enough?", long, "en", None, None, []), ("d", None, long, "en", None, None, ["x"])]
    got = {r["id"]: r["reason"] for r in dataset.judged(spark.createDataFrame(rows, kind)).collect()}
    assert got == {"a": "question_too_short", "b": None, "c": "missing_sources", "d": "missing_or_empty:question"}


def test_taxonomy(spark):
    assert values(spark, [["paper", "paper", "x", "norm", "textbook"], ["structural"], None], lambda v: semantics.allowed_only(v, "content_type", 2), "array<string>") == [["paper", "norm"], [], []]


def test_annotation_isolates_failures(spark):
    rows = spark.createDataFrame([("d", 0, "A first long enough text", "T", False, False, None), ("d", 1, "fail here, long enough", "T", False, False, None), ("d", 2, "x", "T", False, False, None), ("d", 3, "kept text here", "T", False, False, "high")],
                                 "doc_id string, chunk_idx int, content string, title string, has_heading boolean, has_table boolean, trust_level string")

    def backend():
        def ask(prompt):
            if prompt.endswith("fail here, long enough"):
                raise RuntimeError("down")
            return '```{"language":"de","trust_level":"low","summary_short":"A summary that is long enough to stay"}```'

        return ask

    got = {r["chunk_idx"]: (r["mode"], r["trust_level"], r["language"]) for r in semantics.annotate(rows, backend).collect()}
    assert got[0] == ("llm", "low", "de") and got[1][:2] == ("failed", None) and got[2][0] == "structural_rule1_short" and got[3][:2] == ("existing", "high")


def test_nearest_matches_brute_force(spark):
    import numpy as np

    x = np.random.default_rng(0).standard_normal((60, 5))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(99, None)], "vec_id long, embedding array<double>")
    for metric, score in (("ip", -(x @ x.T)), ("l2", ((x[:, None] - x[None]) ** 2).sum(-1))):
        np.fill_diagonal(score, np.inf)
        want = {i: np.argsort(score[i], kind="stable")[:4].tolist() for i in (0, 7)}
        got = vectors.nearest(df, df.where("vec_id in (0, 7)"), 4, metric, blocks=5).orderBy("query_id", "rank").collect()
        assert {q: [r["neighbor_id"] for r in got if r["query_id"] == q] for q in (0, 7)} == want


def test_scored_neighbors_need_matching_lengths(spark):
    df = spark.createDataFrame([(1, ["a", "b"], [0.1, 0.9]), (2, ["a"], [0.1, 0.2])], "id int, ids array<string>, scores array<double>")
    assert [(r["item"], r["chunk_id"]) for r in review.scored_neighbors(df, "id", "ids", "scores").collect()] == [(1, "b"), (1, "a")]
