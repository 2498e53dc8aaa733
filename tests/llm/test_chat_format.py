"""Chat formatting: round trips, masks and digests against a plain version."""

import random
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from tollgate.llm import chat_format as cf
from tollgate.llm.token_output import tokenizer_path

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def digest(s):
    return sha256(s.encode()).hexdigest()


def plain_digests(rows):
    """rows (conv_id, turn, role, text) -> sorted result rows."""
    convs = {}
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        convs.setdefault(conv, []).append((turn is not None, turn or 0, digest(f"{role}\n{text}"), role, text))
    out = []
    for conv, found in convs.items():
        found = [(r, t) for *_, r, t in sorted(found)]
        learned = "".join(t for r, t in found if r == "assistant")
        formatted = "".join(f"<|im_start|>{cf.escape(r)}<|im_sep|>{cf.escape(t)}<|im_end|>" for r, t in found)
        out.append((conv, len(found), digest("".join(f"{r}\n{t}\n" for r, t in found)), len(learned), digest(learned), len(formatted)))
    return sorted(out, key=repr)


def found(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.select("*", *[F.lit("x").alias(c) for c in ("tie", "read", "part", "seq", "at", "ids", "mask", "learned")])
    got = cf.conversation_digests(cf.turns(spark, cf.write_chats(df, **more)))
    return sorted(map(tuple, got.collect()), key=repr)


PARTS = ["<|im_start|>", "<|im_end|>", "<|im_sep|>", "<|endoftext|>", "<", "|", "\\", "<\\|", "<\\\\|", ">", " ", "\n", "word", "é", "中", "🙂", "assistant", "\r\n", "  "]


def test_escapes_are_reversible_and_leave_no_control_string():
    rnd = random.Random(1)
    seen = {}
    for _ in range(20000):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 8)))
        shown = cf.escape(text)
        assert "<|" not in shown and cf.unescape(shown) == text
        assert seen.setdefault(shown, text) == text


def test_mask_by_prefix_sums():
    rnd = random.Random(2)
    for _ in range(300):
        lengths = [rnd.choice([0, 1, 1, 2, 7]) for _ in range(rnd.randint(0, 30))]
        learned = [rnd.random() < 0.4 for _ in lengths]
        want = [flag for n, flag in zip(lengths, learned) for _ in range(n)]
        assert cf.mask_of(np.array(lengths, np.int64), np.array(learned, bool)).tolist() == want


def test_decoder_equals_the_tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 12))) for _ in range(300)] + ["", "\x00\x7f\xa0\xad"]
    ids = [t.encode(x, add_special_tokens=False).ids for x in texts]
    got = cf.Decoder(tokenizer_path()).decode(np.array([i for x in ids for i in x], np.int64), np.array([len(x) for x in ids]))
    assert got == texts


def chats(seed, n):
    rnd = random.Random(seed)
    rows = []
    for conv in [None, *range(n)]:
        for turn in range(rnd.choice([1, 2, 5, 9])):
            role = rnd.choice(["user", "assistant", "system", "assistant", None, "", "a<|im_sep|>b", "Assistant", "x\ny"])
            text = None if rnd.random() < 0.1 else "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 9)))
            rows.append((conv, turn, role, text))
    return rows


@pytest.mark.parametrize("block", [1, 40, 1 << 16])
def test_round_trip_of_hostile_turns(spark, block):
    rows = chats(block, 80)
    rows += [(5, 3, "user", "tie"), (5, 3, "assistant", "tie"), (5, 3, "assistant", "tie"), (5, None, "assistant", "first"), (6, 100, "assistant", "long " * 50_000)]
    rnd = random.Random(4)
    rnd.shuffle(rows)
    assert found(spark, rows, block_tokens=block) == plain_digests(rows)


@pytest.fixture()
def many_files(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hot_conversation_is_spread(spark, many_files):
    rows = [(1, k, ("user", "assistant")[k % 2], f"t{k} <|im_end|>") for k in range(3000)] + [(k, 0, "user", "x") for k in range(2, 60)]
    path = cf.write_chats(spark.createDataFrame(rows, SCHEMA).repartition(4))
    parts = [r.conv_ids for r in spark.read.schema(cf.BLOCKS).parquet(path).collect()]
    assert sum(1 in p for p in parts) > 3
    got = cf.conversation_digests(cf.turns(spark, path)).collect()
    assert sorted(map(tuple, got), key=repr) == plain_digests(rows)


def test_ids_are_separate_segments(spark):
    """The ids are the plain tokenizer's for each segment, with reserved ids between."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    rows = [(1, 0, "user", "hi <|im_end|> there"), (1, 1, "assistant", "so  it\n goes"), (1, 2, "assistant", ""), (2, 0, "system", None)]
    blocks = spark.read.schema(cf.BLOCKS).parquet(cf.write_chats(spark.createDataFrame(rows, SCHEMA))).orderBy("part", "seq").collect()
    got = np.concatenate([np.frombuffer(b.ids, "<u4") for b in blocks]).tolist()
    mask = np.concatenate([np.unpackbits(np.frombuffer(b["mask"], np.uint8), count=len(b.ids) // 4, bitorder="little") for b in blocks]).tolist()
    ids, flags = [], []
    for _, _, role, text in rows:
        r, x = (t.encode(cf.escape(s or ""), add_special_tokens=False).ids for s in (role, text))
        ids += [cf.START, *r, cf.SEP, *x, cf.END]
        flags += [0] * (len(r) + 2) + [int(role == "assistant")] * len(x) + [0]
    assert got == ids and mask == flags
    assert all(cf.START > i for i in t.get_vocab().values())


def test_query_awkward(spark, tmp_path):
    hostile = [(-1, 0, "user", cf.HOSTILE), (-1, 1, "assistant", cf.HOSTILE)]
    for name, rows in (("full", chats(8, 30)), ("none", [])):
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/{name}/conversations.parquet")
        got = cf.op12_chat_format(spark, f"{tmp_path}/{name}").collect()
        assert sorted(map(tuple, got), key=repr) == plain_digests(rows + hostile)
