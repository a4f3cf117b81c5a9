"""Token counts and the BPE codec against the tokenizers library."""

import hashlib
import random

import pytest
from tokenizers import Tokenizer as Library

from gridplace.llm.bpe_codec import Codec, bpe_encode
from gridplace.llm.queries import vocab_path
from gridplace.llm.token_count import Tokenizer, token_counts

from .rows import by_id, frame, hard_rows

PATH = vocab_path()
ODD = [
    "", " ", "  ", "\n", "a'sb don't 'tis !!'s 's's x'll'll '", "'re 'RE 've'm", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>",
    "\n\n  foo \t bar   baz  ", "日本語テキスト 한국어 😀😀 é é", "aaaaaaaa" * 300, "x" * 2000 + " " * 50 + "\n", "12345 ½ ² x2", "​ \x85a \x1c b", "՘႔0",
]


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(1)
    alphabet = "aAb's tlrevmd'  \n\t1é.!<|>ß日"
    return ODD + ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(0, 60))) for _ in range(1500)]


@pytest.fixture(scope="module")
def library(texts):
    lib = Library.from_file(PATH)
    lib.no_padding()
    lib.no_truncation()
    return lib


@pytest.fixture(scope="module")
def expected(library, texts):
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("chunk", [5, 7, 16, 64, 1 << 18])
def test_counts_equal_the_library_at_every_chunk_size(texts, expected, chunk):
    assert Tokenizer(PATH).count(texts, chunk) == [len(e) for e in expected]


def test_chunk_maps_compose_in_any_order():
    tok = Tokenizer(PATH)
    text = ODD[4] + ODD[8] + ODD[9] + "the end of it   \n"
    maps = [tok.chunk_map(text[i : i + 9]) for i in range(0, len(text), 9)]
    left = maps[0]
    for m in maps[1:]:
        left = tok.compose(left, m)
    right = maps[-1]
    for m in reversed(maps[:-1]):
        right = tok.compose(m, right)
    assert tok.apply(left) == tok.apply(right) == tok.count([text])[0]


def test_ids_and_round_trip_equal_the_library(texts, expected, library):
    codec = Codec(PATH)
    coded = codec.encode(texts)
    assert [c.tolist() for c in coded] == expected
    assert [codec.decode(c) for c in coded] == [library.decode(e, skip_special_tokens=False) for e in expected]


def test_bounded_memories_change_nothing(texts, expected, monkeypatch):
    from gridplace.llm import bpe_codec, bpe_pairs, token_count

    for module, name, value in ((bpe_codec, "MEMO_WORDS", 10), (token_count, "MEMO_WORDS", 10), (bpe_pairs, "MAX_STATES", 20), (bpe_pairs, "MEMO_PAIRS", 10)):
        monkeypatch.setattr(module, name, value)
    codec, tok = Codec(PATH), Tokenizer(PATH)
    for i in range(0, 300, 50):
        assert [c.tolist() for c in codec.encode(texts[i : i + 50])] == expected[i : i + 50]
        assert tok.count(texts[i : i + 50]) == [len(e) for e in expected[i : i + 50]]


def test_states_are_bounded_and_share_what_they_hold(texts, expected):
    codec = Codec(PATH, max_states=50)
    sizes = []
    for i in range(0, 300, 10):
        assert [c.tolist() for c in codec.encode(texts[i : i + 10])] == expected[i : i + 10]
        sizes.append(len(codec.states.states))
    assert any(b < a for a, b in zip(sizes, sizes[1:]))  # forgotten, although far below MAX_STATES
    for counting in (False, True):
        states = Codec(PATH).states if not counting else Tokenizer(PATH).words.states
        state = 0
        for byte in " counting the tokens of this sentence, and of that sentence".encode() * 3:
            state = states.move(state, byte)[0]
        for pick in (lambda s: [s[0]], lambda s: s[1]):
            held = [x for s in states.states for x in pick(s)]
            assert len({id(x) for x in held}) == len(set(held))


def test_decoded_texts_can_be_left_out(spark, texts):
    df = frame(spark, list(enumerate(texts[:50])))
    whole, less = bpe_encode(df, PATH), bpe_encode(df, PATH, with_decoded=False, max_states=30)
    assert less.columns == [c for c in whole.columns if c != "decoded"]
    assert by_id((r.doc_id, tuple(r.ids), r.decoded_sha256) for r in less.collect()) == by_id((r.doc_id, tuple(r.ids), r.decoded_sha256) for r in whole.collect())


def test_queries_on_hard_rows(spark, library):
    rows = hard_rows()
    ids = [library.encode(t or "", add_special_tokens=False).ids for _, t in rows]
    got = token_counts(frame(spark, rows), PATH, chunk_chars=1000).collect()
    assert by_id(got) == by_id((i, len((t or "").encode()), len(x), len(x) > 1024) for (i, t), x in zip(rows, ids))
    out = bpe_encode(frame(spark, rows), PATH)
    want = []
    for (i, t), x in zip(rows, ids):
        raw = b"".join(k.to_bytes(4, "little") for k in x)
        want.append((i, len(x), hashlib.sha256(raw).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert by_id(out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == by_id(want)
    assert by_id((r.doc_id, tuple(r.ids), r.decoded) for r in out.collect()) == by_id((i, tuple(x), t or "") for (i, t), x in zip(rows, ids))
    assert token_counts(frame(spark, []), PATH).collect() == [] and bpe_encode(frame(spark, []), PATH).collect() == []


@pytest.mark.parametrize("chunk, task", [(7, 0), (16, 40), (1 << 10, 1 << 14)])
def test_long_texts_are_counted_by_several_tasks(spark, library, chunk, task):
    rows = [(700 + i, t) for i, t in enumerate(ODD)] + [(900, "the " * 3000 + "<|endoftext|>" + "z" * 5000 + "<|endoftext|>")]
    if task > 1000:
        rows += hard_rows()
    got = token_counts(frame(spark, rows).repartition(3), PATH, chunk_chars=chunk, task_chars=task)
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert by_id((r.doc_id, r.n_bytes, r.n_tokens) for r in got.collect()) == by_id(want)


def test_one_long_text_is_cut_over_tasks(spark):
    from gridplace.llm import token_count as M

    text = " ".join(f"word{i}" for i in range(20_000))
    df = spark.createDataFrame([(1, text, len(text))], "doc_id long, text string, n_bytes long")
    parts = M._count_by_chunks(df, PATH, 1000)
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(uid" in plan and "part" in plan.split("hashpartitioning(uid", 2)[-1][:40]  # chunks of one text in several tasks
    assert parts.collect()[0].n_tokens == Tokenizer(PATH).count([text])[0]
