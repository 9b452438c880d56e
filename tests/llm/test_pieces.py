import itertools
import random

import public_tokenizers
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from depthframe.llm import pieces
from depthframe.llm.common import BATCH_BYTES, Scratch
from tests.llm.fixtures import docs, prose

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", " ", "   a  b\n\n c", "Hello WORLD <0x0A> <s> <unk>", "漢字かな🙂é\x00\t", "internationalisation" * 9, "x" * 200, "▁▁a", prose(3, 200), "\n", "q" * 61, "ab" * 31 + "c", "a" * 62, "word.”» x…, don't! (é)é.é—a-b", "re.\nNext### the&&& of%%%", "z" * 251, "ab" * 125]


def test_equals_the_library_and_goes_back(spark):
    model = SentencePieceProcessor(model_file=PATH)
    table = pieces.read_pieces(PATH)
    rows = list(enumerate(TEXTS)) + [(9, TEXTS[9]), (None, "x y")]
    for hot in (0, 5, 1000):
        out = pieces.encode(docs(spark, rows, extra=True).drop("ids"), table, hot_units=hot)
        got = out.withColumn("back", pieces.decode_column(spark, table)).collect()
        assert len(got) == len(rows) and "score" in out.columns
        for r in got:
            assert list(r.ids) == model.encode(r.text or "")
            assert r.back == (r.text or "").replace("▁", " ")


def test_round_trip_is_told_by_the_encoding_pass(spark, tmp_path):
    table = pieces.read_pieces(PATH)
    frame = docs(spark, list(enumerate(TEXTS)), extra=True).withColumn("same", F.lit("replaced"))
    out = pieces.encode(frame, table, hot_units=5, round_trip="same")
    assert out.columns[-2:] == ["ids", "same"] and all(r.same is True for r in out.collect())
    bare = pieces.Pieces(("a", "b", "ab", "▁"), (0, 1, 2, 3), (-2.0, -3.0, -1.0, -4.0), (), 9, True)
    told = {r.text: r.same for r in pieces.encode(docs(spark, list(enumerate(["ab a", "ab x", None]))), bare, round_trip="same").collect()}
    assert told == {"ab a": True, "ab x": False, None: True}
    docs(spark, list(enumerate(TEXTS))).write.parquet(f"{tmp_path}/documents.parquet")
    plan = pieces.op8_sentencepiece(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") <= 1  # texts are packed; nothing is decoded by a second worker of a task


def test_no_piece_spans_a_cut():
    table = pieces.read_pieces(PATH)
    splitter = table.splitter()
    held = {p[i : i + 2] for p in table.names for i in range(len(p) - 1)}
    for text in TEXTS:
        parts = pieces.units(text, splitter)
        assert "".join(parts) == (pieces.MARK + text.replace(" ", pieces.MARK) if text else "")
        assert not any(a[-1] + b[0] in held for a, b in zip(parts, parts[1:]))
    assert splitter.findall("▁a.b▁▁c,") == ["▁a", ".", "b", "▁▁c", ","]


def unigram():
    names = ["▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "▁ab", "ca"]
    scores = [-3.0, -2.0, -2.5, -2.2, -3.1, -3.0, -4.2, -2.9, -3.3, -2.7]
    return pieces.Pieces(tuple(names), tuple(range(len(names))), tuple(scores), (), 99, False)


def best(unit, table):
    score = dict(zip(table.names, table.scores))
    least = min(table.scores) - pieces.UNKNOWN_PENALTY
    out = []
    for cuts in itertools.chain.from_iterable(itertools.combinations(range(1, len(unit)), k) for k in range(len(unit))):
        parts = [unit[i:j] for i, j in zip((0, *cuts), (*cuts, len(unit)))]
        if all(p in score or len(p) == 1 for p in parts):
            out.append(sum(score.get(p, least) for p in parts))
    return max(out)


def test_viterbi_fold_equals_brute_force(spark):
    table = unigram()
    r = random.Random(1)
    words = {"▁" + "".join(r.choice("abcx") for _ in range(r.randrange(1, 8))) for _ in range(40)}
    vocabulary = spark.createDataFrame([(w, 1) for w in words], "unit string, n long")
    score = dict(zip(table.names, table.scores))
    least = min(table.scores) - pieces.UNKNOWN_PENALTY
    for row in pieces.segment(vocabulary, table).collect():
        cuts = [0, *row.cuts, len(row.unit)]
        got = sum(score.get(row.unit[i:j], least) for i, j in zip(cuts, cuts[1:]))
        assert abs(got - best(row.unit, table)) < 1e-9


def test_folds_by_bits_and_by_heap_agree(spark):
    table = pieces.read_pieces(PATH)
    words = [w for t in TEXTS for w in pieces.units(t, table.splitter()) if len(w) <= pieces.SHORT]
    vocabulary = spark.createDataFrame([(w, 1) for w in set(words)], "unit string, n long")
    short = {r.unit: list(r.cuts) for r in pieces.segment(vocabulary, table).collect()}
    long = {r.unit: list(r.cuts) for r in pieces._long(vocabulary, pieces._table(spark, table), table.longest).collect()}
    assert short == long


def test_empty_table(spark):
    assert pieces.encode(docs(spark, []), pieces.read_pieces(PATH)).select(F.col("ids")).count() == 0


def test_long_unit_without_blanks(spark):
    """A run of a million letters and ideographs is cut where no piece holds two neighbours."""
    r = random.Random(8)
    text = "".join(r.choice("abcdefghijklmnopqrstuvwxyz漢字かな水火木金土日月") for _ in range(1_000_000))
    table = pieces.read_pieces(PATH)
    parts = pieces.units(text, table.splitter(), table.neighbours())
    assert "".join(parts) == pieces.MARK + text and max(map(len, parts)) <= pieces.SHORT
    model = SentencePieceProcessor(model_file=PATH)
    got = pieces.encode(docs(spark, [(1, text), (2, text[:5001])]), table).collect()
    assert all(list(x.ids) == model.encode(x.text) for x in got)


def test_columns_with_the_names_of_results(spark):
    import corpus_pipeline

    frame = docs(spark, [(1, "one two"), (2, None)], extra=True).withColumn("round_trip", F.lit("kept"))
    out = corpus_pipeline.piece_stage(spark, frame, "")
    assert out.columns[-2:] == ["ids", "round_trip"] and all(r.round_trip is True and r.score == "kept" for r in out.collect())


def test_digests_of_parts_are_those_of_the_whole(spark, monkeypatch):
    import hashlib

    rows = [(i, f"{prose(i % 7, 20)} u{i}") for i in range(40)] + [(None, "no id"), (None, None), (5, "again"), (6, "")]
    seen = []
    stage = Scratch.stage
    monkeypatch.setattr(Scratch, "stage", lambda self, df, name, *more, **named: seen.append((name, df.columns)) or stage(self, df, name, *more, **named))
    model, table = pieces.read_pieces(PATH), docs(spark, rows).select("doc_id", "text")
    got = sorted((str(r.doc_id), r.n_pieces, r.ids_sha256, r.round_trip) for r in pieces.digests(table, model).collect())
    parts = [columns for name, columns in seen if name.startswith("part")]
    assert len(parts) > 1 and all(columns == ["doc_id", "n_pieces", "ids_sha256", "round_trip"] for columns in parts)
    whole = pieces.encode(table, model).collect()
    assert got == sorted((str(r.doc_id), len(r.ids), hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest(), True) for r in whole)


def test_texts_are_cut_twice_in_batches_of_bounded_size(spark, monkeypatch):
    # once for the distinct units and once for their numbers; before, three times and with a task's texts at once
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        read.add(1)
        return text

    settings = []
    stage = Scratch.stage
    monkeypatch.setattr(Scratch, "stage", lambda self, *args, **named: settings.append(self.settings.get(BATCH_BYTES)) or stage(self, *args, **named))
    rows = [(i, f"{prose(i % 7, 20)} u{i} u{i} v") for i in range(40)]
    got = pieces.digests(docs(spark, rows).select("doc_id", seen("text").alias("text")), pieces.read_pieces(PATH)).collect()
    assert len(got) == len(rows) and all(r.round_trip for r in got)
    assert read.value == 2 * len(rows) and settings and all(settings)


def test_gaps_are_filled_in_order(spark):
    # rarer units that occur again, at both ends and side by side
    rows = list(enumerate(["zq xw zq", "xw", "zq the zq xw xw", "the", "", None]))
    model, table = SentencePieceProcessor(model_file=PATH), pieces.read_pieces(PATH)
    for hot in (0, 1, 2):
        out = pieces.encode(docs(spark, rows), table, hot_units=hot, round_trip="same").collect()
        assert all(list(r.ids) == model.encode(r.text or "") and r.same for r in out)
