import numpy as np
from test_memory import peak_mb

from fumarole.llm import neighbours


def test_scores_hold_few_rows_of_cosines():
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(neighbours.SAMPLE_ROWS, neighbours.DIRECTIONS)).astype(np.float32)
    model = neighbours.Model(np.ones(neighbours.TERMS, np.float32), rng.normal(size=(neighbours.TERMS, neighbours.DIRECTIONS)).astype(np.float32),
                             vectors, rng.integers(0, 2, len(vectors)).astype(float), 0.5)
    counts = rng.poisson(0.3, (1024, neighbours.TERMS)).astype(np.float32)
    assert peak_mb(lambda: model.score(counts)) < 40
