"""Fill-in-the-middle, chat formatting and the Merkle manifest against plain versions."""

from collections import Counter, defaultdict

import pytest
import zstandard
from pyspark.sql import functions as F

import brute
import tricky
from conftest import TESTDATA
from tidemark.llm import chat_format, fill_middle, merkle

FOLDER = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module", params=["tricky", "table"])
def docs(request, spark):
    if request.param == "tricky":
        return tricky.frame(spark).cache()
    return spark.read.parquet(f"{FOLDER}/documents.parquet").cache()


def multiset(rows):
    return Counter(map(tuple, rows))


# -- fill in the middle ----------------------------------------------------


def test_fill_middle(docs):
    want = []
    for r in docs.select("doc_id", "text").collect():
        *cuts, output = brute.cut_and_turned(r.doc_id, r.text)
        want.append((r.doc_id, *cuts, brute.sha(output), brute.sha(r.text or "")))
    assert multiset(fill_middle.fim_report(docs).collect()) == multiset(want)


def test_fill_middle_texts_and_round_trip(docs):
    outputs = fill_middle.transformed(fill_middle.store(docs), fim_percent=100, spm_percent=50)
    texts = fill_middle.plain_texts(outputs).select("doc.*", "form", "output")
    assert texts.columns == [*docs.columns, "form", "output"]
    got = texts.select("doc_id", "form", "output").collect()
    want = []
    for r in docs.select("doc_id", "text").collect():
        _, form, _, _, output = brute.cut_and_turned(r.doc_id, r.text, fim=100, spm=50)
        want.append((r.doc_id, form, output))
    assert multiset(got) == multiset(want)
    assert {"psm", "spm"} <= {r.form for r in got}
    back = fill_middle.restored(outputs, "original").select("doc.doc_id", "original").collect()
    assert multiset(back) == multiset((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())


@pytest.mark.parametrize("size", [1, 7, 40])
def test_frames_of_any_size(monkeypatch, size):
    """Cuts at and between frames, marks across the frames of an output, units longer than a frame."""
    monkeypatch.setattr(fill_middle, "FRAME_BYTES", size)
    packer, unpacker = zstandard.ZstdCompressor(), zstandard.ZstdDecompressor()
    texts = [t or "" for t in tricky.texts()[:40]] + ["<P", "a <", "<<<S <P M>", "ééé é\t日本語 x" * 30, " lead", "<P> in it"]
    for i, text in enumerate(texts):
        frames = fill_middle.framed(packer, text.encode())
        assert b"".join(map(unpacker.decompress, frames.data)).decode() == text
        assert frames.chars[-1:] == ([len(text)] if text else [])
        marked = any(m in text for m in ("<P>", "<S>", "<M>"))
        done = fill_middle._transform(packer, unpacker, frames, str(i), marked, (42, 100, 50))
        n, form, prefix, middle, output = brute.cut_and_turned(i, text, fim=100, spm=50)
        assert (frames.units[-1:] or [0])[0] == n
        assert done[:3] == (form, prefix, middle)
        assert b"".join(map(unpacker.decompress, done[3].data)).decode() == output
        assert b"".join(fill_middle._restore(unpacker, done[3], form)).decode() == text


def test_only_cut_frames_are_opened(monkeypatch):
    monkeypatch.setattr(fill_middle, "FRAME_BYTES", 100)
    packer, opened = zstandard.ZstdCompressor(), []

    class Unpacker:
        def decompress(self, data):
            opened.append(data)
            return zstandard.ZstdDecompressor().decompress(data)

    frames = fill_middle.framed(packer, b"word " * 2000)
    assert len(frames.data) > 90
    cut = fill_middle._cut(Unpacker(), frames, 1001)
    assert len(opened) == 1 and cut.chars == 1001 * 5 - 1


def test_fill_middle_of_nothing(spark):
    empty = tricky.empty(spark)
    assert fill_middle.fim_report(empty).collect() == []
    assert fill_middle.fill_middle(empty).collect() == []


# -- chat formatting -------------------------------------------------------

ROLES = [None, "", "user", "assistant", "system", "tool", "a\nb", "x\\ny\\\n", "</s>[ROLE] u\n", "Assistant"]
SAID = [
    None, "", " ", "plain", "</s>[INST] ok [/INST]", "<\\s>", "<\\\\/s> [\\INST] [SYS] x", "[/INST] first", "<", "</s",
    "\\", "[ROLE] a\nb", "line\nline\n", "日本語 <s>😀</s>", "x" * 40_000 + "</s>", "<</s>>", "[[INST]]", "\\\\</s>",
]


@pytest.fixture(scope="module")
def talk(spark):
    rows = [(c, t, ROLES[(c * 5 + t) % len(ROLES)], SAID[(c * 7 + t * 3) % len(SAID)]) for c in range(30) for t in range(c % 9 + 1)]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "none"), (7, None, "user", "no turn"), rows[40], rows[40]]
    rows += [(99, t, "assistant", f"{t} <s>") for t in range(3000)]
    rows = [(*r, "output", "doc") for r in rows]
    names = "conv_id bigint, turn bigint, role string, text string, output string, doc string"
    return spark.createDataFrame(rows, names).repartition(7)


def conversations(rows):
    out = defaultdict(list)
    for r in rows:
        out[r.conv_id].append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    return {c: [t[2:] for t in sorted(x)] for c, x in out.items()}


def test_chat_report(talk):
    got = {r.conv_id: r for r in chat_format.chat_report(talk).collect()}
    want = conversations(talk.collect())
    assert set(got) == set(want)
    for c, turns in want.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == brute.sha("".join(f"{r}\n{t}\n" for r, t in turns)), turns
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), brute.sha(loss))


def test_chat_output_and_mask(talk):
    for r in chat_format.format_rows(talk).collect():
        assert "".join(s.text for s in r.segments) == r.output
        # Only the marks of the template are control strings.
        assert r.output.count("</s>") == (len(r.segments) - 1) // 3
        assert r.output.count("<s>") == 1


def test_chat_of_nothing(spark, talk):
    assert chat_format.chat_report(talk.limit(0)).collect() == []


RECORDS = {
    '{"prompt":"a","completion":"b","id":7,"layout":"x"}': ("prompt_completion", [("user", "a"), ("assistant", "b")]),
    '{"prompt":"a","response":"","system":"s"}': (
        "prompt_response", [("system", "s"), ("user", "a"), ("assistant", "")]),
    '{"instruction":"do","input":"it","output":"ok"}': ("instruction", [("user", "do\n\nit"), ("assistant", "ok")]),
    '{"instruction":"do","input":null,"output":"ok"}': ("instruction", [("user", "do"), ("assistant", "ok")]),
    '{"question":"q","answer":"a"}': ("question_answer", [("user", "q"), ("assistant", "a")]),
    '{"messages":[{"role":"user","content":"hi"},{"role":"GPT","content":null}]}': (
        "messages", [("user", "hi"), ("assistant", "")]),
    '{"messages":[{"role":"user","text":"hi"},{"content":null,"role":"tool","text":"t"}],"system":"s"}': (
        "message_texts", [("system", "s"), ("user", "hi"), ("tool", "t")]),
    '{"conversations":[{"from":"human","value":"x"},{"from":"gpt","value":"y"}]}': (
        "from_value", [("user", "x"), ("assistant", "y")]),
    '{"dialogue":[{"user":"1","assistant":"2"},{"user":"3","assistant":"4"}]}': (
        "pairs", [("user", "1"), ("assistant", "2"), ("user", "3"), ("assistant", "4")]),
    '{"role":"system","content":"c"}': ("content_row", [("system", "c")]),
    '{"prompt":"alone"}': (None, []),
    '{"prompt":"a","completion":"b","messages":[{"role":"user","content":"?"}]}': (None, []),
    "no json": (None, []),
    "{}": (None, []),
    None: (None, []),
}


def test_layouts(spark):
    rows = spark.createDataFrame([(i, j) for i, j in enumerate(RECORDS)], "id int, json string")
    made = chat_format.canonical_turns(rows, chat_format.from_json(F.col("json")), keep=["id"])
    got = {r.doc.id: (r.layout, [tuple(t) for t in r.turns]) for r in made.collect()}
    assert [got[i] for i in range(len(RECORDS))] == list(RECORDS.values())


def test_fingerprints_differ():
    prints = [f for layout in chat_format.LAYOUTS for f in layout.fingerprints()]
    assert len(prints) == len(set(prints))


def test_chat_is_native(talk, capsys):
    chat_format.chat_report(talk).explain()
    plan = capsys.readouterr().out
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
    assert plan.count("Exchange hashpartitioning") == 1


# -- Merkle manifest -------------------------------------------------------


def test_merkle(docs):
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    rows = [tuple(r) for r in docs.select(*columns).collect()]
    assert multiset(merkle.merkle_report(docs).collect()) == multiset(brute.merkle(rows))


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 272, 4096, 4097])
def test_merkle_sizes(spark, n):
    """One source of ``n`` rows beside small ones: runs and blocks that end early, late, or just so."""
    rows = [(i * 3, "hot", None, i, "Text") for i in range(n)] + [(-1, None, "en", 1, ""), (-2, "é", "en", None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    assert multiset(merkle.merkle_report(docs.repartition(5)).collect()) == multiset(brute.merkle(rows))


@pytest.mark.parametrize("groups", [1, 16, 17, 300])
def test_merkle_many_sources(spark, groups):
    rows = [(i, f"s{i % groups}", "en", i, "T") for i in range(2 * groups)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    assert multiset(merkle.merkle_report(docs).collect()) == multiset(brute.merkle(rows))


def test_merkle_of_nothing(spark):
    assert merkle.merkle_report(tricky.empty(spark)).collect() == []


def test_merkle_rows_of_blocks_are_bounded(spark, docs):
    tree = merkle.manifest(merkle.leaves(docs))
    sizes = tree.rows[0].select(F.aggregate("tree", F.lit(0), lambda n, t: n + F.size(t["children"])).alias("n"))
    assert sizes.agg(F.max("n")).first()[0] <= merkle.BLOCK
    assert sizes.agg(F.sum("n")).first()[0] == docs.count()


def test_merkle_leaves_join_nothing(docs, capsys):
    """Below the last explode, joins see blocks only."""
    merkle.proofs(merkle.manifest(merkle.leaves(docs))).explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    head = plan[: plan.index("Generate explode")]
    assert "Join" not in head
