import numpy as np
import pytest

from docweave.llm import packed


@pytest.mark.parametrize("width", [4, 5, 8])
@pytest.mark.parametrize("ids", [np.arange(40) * 3 + 7, np.array([np.iinfo(np.int64).min, np.iinfo(np.int64).max, 0, -1, 5] * 8), np.stack([np.arange(40), np.arange(40)[::-1] * 70_000], 1)])
def test_payloads_give_back_what_was_packed(width, ids):
    rng = np.random.default_rng(width)
    h = rng.integers(0, 1 << 63, 600).astype(np.uint64) * np.uint64(2)
    doc = np.sort(rng.integers(0, 40, 600))
    place = packed.bucket_of(h, 13)
    seen = 0
    for b, payload in packed.pack(h, doc, ids, place, 13, width):
        got_ids, counts, keys = packed.unpack(payload, width)
        mine = place == b
        assert (keys == packed.low(h[mine], width) if width < 8 else keys == h[mine]).all()
        assert (np.repeat(got_ids, counts, axis=0) == ids[doc[mine]]).all()
        seen += mine.sum()
    assert seen == 600


def test_bytes_a_key_stay_flat_while_rows_hold_many():
    """Documents with ever fewer keys in a bucket cost little more: buckets from 25 to 6,401."""
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, 400_000).astype(np.uint64) * np.uint64(2)
    doc = np.repeat(np.arange(2000), 200)
    size = []
    for n in (25, 401, 6401):
        rows = [p for _, p in packed.pack(h, doc, np.arange(2000) * 5, packed.bucket_of(h, n), n, 4)]
        size.append(sum(map(len, rows)) / len(h))
    assert size[-1] < 8  # four of them are the key; an id of eight bytes and a count of four made it 16
