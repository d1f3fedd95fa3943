import base64
import zlib

import numpy as np
import pyarrow as pa
import pytest
import tiktoken

from ledgerlake.llm import text as T
from ledgerlake.llm import training_order as O
from ledgerlake.sources.workspace import fresh_path


@pytest.fixture(scope="module")
def plain():
    with open(O.TOKENIZER, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("plain", pat_str=O.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    with open(O.TOKENIZER, "rb") as f:
        return O.Encoder(f.read())


TRICKY = ["", " ", "a", " a", "a ", "a  b", "a \n b", "it's  we'll", "x\n\ny z", " a  b", "1 2,3 é",
          "\u00a0 a \u2003b \u00e9t\u00e9 x\u3000", "a \n b\t c", "a" * 3000, "don't 't", "tab\t x", "a  b"]


def test_encodes_as_the_tokenizer(encoder, plain, corpus):
    texts = [*TRICKY, *(r[1] or "" for r in corpus(8))]
    for _ in range(2):
        for chunk in T.chunks(pa.array(texts), 5_000):
            ids, offsets = encoder.encode(chunk)
            assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [
                [*plain.encode_ordinary(t), encoder.end] if t else []
                for t in texts[chunk.first:chunk.first + chunk.texts]]


@pytest.mark.parametrize("count", [1, 2, 3, 17, 256, 1000])
def test_slots_are_a_permutation_that_the_key_sets(count):
    first, second = (O.slots(np.arange(count), count, key) for key in (1, 2))
    assert sorted(first.tolist()) == list(range(count))
    assert count < 10 or first.tolist() != second.tolist() != list(range(count))


def test_round_trip(spark, documents, encoder, plain):
    rows, df = documents(9, extra=[(5000, t, None, None, 0, "", "", 0) for t in TRICKY]
                         + [(5001, "twice", None, None, 0, "", "", 0)] * 2)
    folder = f"file://{fresh_path(spark, 'shards')}"
    placed = O.write_shards(df, folder, length=16, shard_slots=50).collect()
    slots = [x for part in O.read_slots(folder) for x in part]
    assert sorted(r.slot for r in placed) == list(range(len(slots)))
    texts = {}
    for r in sorted(placed, key=lambda r: r.slot):
        tokens = slots[r.slot][:r.n_tokens]
        assert zlib.crc32(tokens.tobytes()) == r.crc32 and (slots[r.slot][r.n_tokens:] == encoder.end).all()
        assert r.shard == f"shard-{r.slot // 50:08d}.bin" and r.offset == r.slot % 50 * 32
        texts.setdefault((r.doc_id, r.position), []).append(tokens.tolist())
    want = {}
    for r in rows:
        if r[1]:
            ids = [*plain.encode_ordinary(r[1]), encoder.end]
            for k in range(0, len(ids), 16):
                want.setdefault((r[0], k // 16), []).append(ids[k:k + 16])
    assert {k: sorted(v) for k, v in texts.items()} == {k: sorted(v) for k, v in want.items()}
    resumed = np.concatenate(list(O.read_slots(folder, 37, 120, 8)))
    assert (resumed == np.array(slots[37:120])).all()


def test_no_documents(spark, no_documents):
    folder = f"file://{fresh_path(spark, 'shards')}"
    assert O.write_shards(no_documents, folder).count() == 0
    assert list(O.read_slots(folder)) == []
