import numpy as np

from gramline.llm import arrays


def test_long_runs_have_the_hashes_of_short_ones(monkeypatch):
    """Cutting the work in runs changes no hash, whatever the strings' lengths and overlaps."""
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    start = np.sort(rng.integers(0, 5000, 900))
    end = np.minimum(start + rng.choice([0, 1, 7, 300], 900), 5000)
    whole = arrays._hashes(data, start, end)
    for size in (1, 16, 1000):
        monkeypatch.setattr(arrays, "SLICE_BYTES", size)
        assert (arrays.hashes(data, start, end) == whole).all()
        back = slice(None, None, -1)
        assert (arrays.hashes(data, start[back], end[back]) == whole[back]).all()
    monkeypatch.undo()
    words = [data[a:b].tobytes() for a, b in zip(start, end, strict=True)]
    assert len({w.lower() for w in words}) == len(set(whole.tolist()))
