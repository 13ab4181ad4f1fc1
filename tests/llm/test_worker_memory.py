"""What a worker holds while it scores texts, and what it remembers of them."""

import tracemalloc

import numpy as np
import pyarrow as pa
from searchloom.llm import tokens
from searchloom.llm.network import fit_network
from searchloom.llm.quality import QualityModel
from searchloom.llm.queries import word_tokenizer
from searchloom.llm.blocks import blocks


def test_scoring_holds_little_beside_the_texts():
    drawn = np.random.default_rng(1)
    texts = [" ".join(f"w{n}," for n in drawn.integers(0, 5000, 400)) for _ in range(800)]
    column = pa.array(texts)
    x = drawn.normal(size=(40, 129))
    model = QualityModel(drawn.normal(size=(4096, 64)).astype(np.float32), fit_network(x, (x[:, 0] > 0) * 1.0))
    alone = np.concatenate([model.score_column(pa.array([t])) for t in texts[:20]])
    tracemalloc.start()
    try:
        scores = model.score_column(column)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert column.nbytes > 2 << 20 and peak < 80 << 20
    assert np.allclose(scores[:20], alone, rtol=1e-12)


def test_a_worker_forgets_pre_tokens_and_ids_stay_the_same():
    def spelled(n: int) -> str:
        return "".join(chr(97 + int(d)) for d in str(n))

    path = word_tokenizer()
    known = tokens.Tokenizer(path)
    texts = [" ".join(spelled(7 * n + 1_000_000) for n in range(first, first + 50_000)) for first in range(0, 450_000, 50_000)]
    for block in blocks(pa.array(texts), 1):
        found = known.encode(block)
        assert len(known.hashes) <= 350_000
    fresh = tokens.Tokenizer(path).encode(next(blocks(pa.array(texts[-1:]))))
    assert len(found) == 1 and np.array_equal(found[0], fresh[0])
