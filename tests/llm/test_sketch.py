import pickle

import numpy as np
import pyarrow as pa

from tallybook.llm import sketch


def test_no_repeated_hash_is_missed(spark, odd, monkeypatch):
    monkeypatch.setattr(sketch, "FLUSH", 500)
    rng = np.random.default_rng(3)
    parts = [rng.integers(0, 2**63, 3000).astype(np.uint64) for _ in range(4)]
    parts[1][:50] = parts[0][:50]
    parts[2][:200] = parts[2][200]
    df = spark.createDataFrame([(p.astype(np.int64).tolist(),) for p in parts], "h array<long>").repartition(4)

    def hashes(batches):
        for batch in batches:
            yield batch.column(0).flatten().to_numpy().astype(np.uint64)

    found = sketch.build(df, hashes, 12_000, heavy_from=150)
    every, counts = np.unique(np.concatenate(parts), return_counts=True)
    repeated = found.repeated(every)
    assert repeated[counts > 1].all()
    assert repeated[counts == 1].mean() < 0.2
    level = found.level(every)
    assert level[counts >= 150].tolist() == [7] and (level[counts < 150] == 0).mean() > 0.99


def test_gaps_of_any_width():
    for cells in ([0], [65_535], [0, 65_534, 131_070, 8_000_000], list(range(0, 400_000, 7))):
        size, data = sketch._gaps(np.array(cells, np.uint32))
        assert sketch._from_gaps(data, size).tolist() == cells
    assert isinstance(pa.array([1]), pa.Array)


def test_a_worker_holds_the_bits_once():
    packed = {k: pa.compress(np.full(1 << 13, k + 1, np.uint8), codec="zstd", asbytes=True) for k in (0, 1)}
    none = np.zeros(0, np.uint32)
    sent = pickle.loads(pickle.dumps(sketch.Sketch(16, 2, packed, none, none)))
    rows = [row.tolist() for row in sent.rows()]
    assert rows == [[1] * (1 << 13), [2] * (1 << 13)]
    assert not sent.bits
    assert [row.tolist() for row in pickle.loads(pickle.dumps(sent)).rows()] == rows
