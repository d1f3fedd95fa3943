import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import text as T

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t.ü1|\x0b", max_size=30)), max_size=12)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_are_those_of_the_pattern(texts, limit):
    for inside, pattern in ((T.SPACED, r"[^\x20\x09-\x0D]+"), (T.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        got: list = []
        for chunk in T.chunks(pa.array(texts, pa.string()), limit):
            data = T.lower(chunk.data)
            found = T.words(T.Chunk(chunk.first, data, chunk.offsets), inside)
            raw = data.tobytes()
            for a, b in zip(found.offsets[:-1], found.offsets[1:]):
                got.append([raw[s:e].decode() for s, e in zip(found.starts[a:b], found.ends[a:b])])
        lower = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for t in texts]
        assert got == [re.findall(pattern, t) for t in lower]


def test_equal_ranges_have_equal_hashes_and_others_do_not():
    data = np.frombuffer(b"abcabcabd", np.uint8)
    h = T.Hasher(data)(np.array([0, 3, 6, 0]), np.array([3, 6, 9, 2]))
    assert h[0] == h[1] and len(set(h.tolist())) == 3


def test_windows_stay_in_their_text():
    assert T.window_starts(np.array([0, 2, 2, 6]), 3).tolist() == [2, 3]
    assert T.window_starts(np.array([0, 5]), 1).tolist() == [0, 1, 2, 3, 4]
