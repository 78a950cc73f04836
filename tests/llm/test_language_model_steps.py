"""Steps of training and scoring: same values as written plainly, arrays used again."""

import tracemalloc
import zlib

import numpy as np
import pytest

from tokenloom.llm import lm_scoring as lm


def weights(size: float = 1.0) -> dict[str, np.ndarray]:
    w = {k: x.astype(float) for k, x in lm.start_weights(np.full(lm.SYMBOLS, 1 / lm.SYMBOLS)).items()}
    return {k: x * size if k in ("query", "out", "group") else x for k, x in w.items()}


@pytest.mark.parametrize("size", [1, 100])
def test_slopes_of_any_size_are_those_of_the_loss(size):
    """Also where exponentials need a shift, and in arrays left by a larger step."""
    draw = np.random.default_rng(0)
    w, space = weights(size), lm.Space()
    for n in (6, 3):
        x, y = draw.integers(0, lm.SYMBOLS, (2, n, 10))
        used = draw.random((n, 10)) < 0.8
        slopes = lm.slopes(w, x, y, used, space)
    logits = lm.forward(w, x)[0]
    assert (np.abs(logits).max() > lm.SAFE) == (size > 1) and np.isfinite(logits).all()
    loss = lambda w: -(lm.log_shares(lm.forward(w, x)[0], y) * used).sum() / used.sum()
    for name, value in w.items():
        at = np.unravel_index(np.abs(slopes[name]).argmax(), value.shape)
        before, step = value[at], 1e-6
        value[at] = before + step
        up = loss(w)
        value[at] = before - step
        assert abs((up - loss(w)) / (2 * step) - slopes[name][at]) < 1e-4 * max(1, abs(slopes[name][at])), name
        value[at] = before


def test_a_step_uses_the_arrays_of_the_one_before():
    draw = np.random.default_rng(1)
    w, space = lm.start_weights(np.full(lm.SYMBOLS, 1 / lm.SYMBOLS)), lm.Space()
    x, y = draw.integers(0, lm.SYMBOLS, (2, lm.STEP, lm.LENGTH))
    used, peaks = np.ones(x.shape, bool), []
    tracemalloc.start()
    for _ in range(2):
        tracemalloc.reset_peak()
        held = tracemalloc.get_traced_memory()[0]
        lm.slopes(w, x, y, used, space)
        peaks.append(tracemalloc.get_traced_memory()[1] - held)
    tracemalloc.stop()
    assert peaks[1] < 700_000 < 2_000_000 < peaks[0]


def test_windows_of_many_texts_are_those_of_each():
    draw = np.random.default_rng(2)
    of = draw.integers(0, lm.SYMBOLS, 1 << 16).astype(np.int16)
    texts = [draw.integers(0, 50_000, n).astype(np.uint16) for n in (0, 1, 500, 31, 32, 0, 33, 95, 96, 97, 2)]
    for turn in range(lm.ROUNDS):
        want = []
        for ids in texts:
            padded = [lm.BEGIN, *ids.tolist(), lm.STOP]
            begin = (turn + zlib.crc32(ids.tobytes())) % lm.ROUNDS * lm.LENGTH
            want.append([padded[i : i + lm.LENGTH + 1] for i in range(begin, len(padded) - 1, lm.ROUNDS * lm.LENGTH)])
        line, starts, ends, many = lm.window_places([x.tobytes() for x in texts], turn)
        assert many.tolist() == list(map(len, want))
        assert [line[i:j].tolist() for i, j in zip(starts, ends)] == sum(want, [])
        rows = lm.window_rows(of[line], starts, ends)
        for row, ids in zip(rows, sum(want, []), strict=True):
            assert row.tolist() == [*of[ids].tolist(), *[-1] * (lm.LENGTH + 1 - len(ids))]


def test_bytes_of_texts_from_a_table():
    pieces = [b"a", b"", b" \xc3\xa9x", b"\xff", b""]
    texts = [np.array(x, np.uint16) for x in ([], [2, 0, 1, 3], [1, 4], [0], [])]
    want = [b"".join(pieces[i] for i in ids) for ids in texts]
    assert lm.decode(texts, lm.piece_table(pieces)) == want


def test_scores_do_not_depend_on_the_texts_beside():
    """Nothing is left from batches of another size."""
    symbols = lm.make_symbols(np.ones(1 << 16), [], 50256)
    begins = np.zeros(1 << 16, bool)
    begins[::3] = begins[lm.STOP] = True
    scorer = lm.Scorer(lm.start_weights(symbols.rates), symbols, begins)
    draw = np.random.default_rng(3)
    texts = [draw.integers(0, 50_000, n).astype(np.uint16) for n in draw.integers(0, 200, 300)]
    together = scorer.token_logs(texts, begins)
    for i in (0, 7, 150, 299):
        alone = scorer.token_logs(texts[i : i + 1], begins)
        for a, b in zip(together, alone, strict=True):
            assert np.allclose(a[i], b[0], atol=2e-5)
