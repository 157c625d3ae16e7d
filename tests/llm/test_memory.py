"""What a task of the language model holds at once, and that it still counts everything."""

import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from lexvane.llm import language_model
from lexvane.llm import sequences as seq


class Frame:
    """Hands out the function that tasks would run."""

    schema = T.StructType([T.StructField("doc_id", T.LongType())])

    def select(self, *_):
        return self

    def mapInArrow(self, run, schema):  # noqa: N802
        return run


class Block:
    """A broadcast whose value is made when it is asked for, as if read from disk."""

    alive = most = 0

    def __init__(self, make):
        self.make = make

    @property
    def value(self):
        if "_value" not in vars(self):
            Block.most = max(Block.most, Block.alive + 1)
            self._value = self.make()
        return self._value


class Counted(language_model.Filter):
    def __init__(self, *args):
        super().__init__(*args)
        Block.alive += 1

    def __del__(self):
        Block.alive -= 1


def texts(n, size):
    """Random words of seven letters, nearly all pairs different."""
    letters = np.random.default_rng(n).integers(97, 123, (n, size, 8), np.uint8)
    letters[:, :, 7] = 32
    return [row.tobytes().decode() for row in letters]


def peak(run, batch):
    """Bytes that a task takes at most besides tables made once; what it gives is let go at once."""
    language_model.tokens([b"once"])
    tracemalloc.start()
    for _ in run(iter([batch])):
        pass
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most


def test_counting_holds_little_besides_its_numbers():
    some = texts(150, 10_000)
    run = language_model._counted(Frame(), True, 54)
    # A hash and a count of each of 1.5 million pairs, and the work on one chunk.
    assert peak(run, pa.RecordBatch.from_pydict({"text": some})) < 1_500_000 * 12 + 30e6


@pytest.mark.parametrize("shift", [64, 63, 50])
@pytest.mark.parametrize("flush", [300, 4_000_000])
def test_all_pairs_are_handed_on(monkeypatch, shift, flush):
    monkeypatch.setattr(language_model, "FLUSH", flush)
    some = [*texts(20, 100), None, "", *texts(20, 100)]
    got = Counter()
    for batch in language_model._counted(Frame(), True, shift)(iter([pa.RecordBatch.from_pydict({"text": some})])):
        for bucket, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
            keys = np.frombuffer(keys, np.uint32)
            counts = np.frombuffer(counts, np.uint8 if len(counts) == len(keys) else np.uint64)
            got.update({(bucket, k): 0 for k in keys.tolist()})
            for k, n in zip(keys.tolist(), counts.tolist()):
                got[bucket, k] += n
    h = language_model.pairs(*language_model.tokens([(t or "").encode() for t in some]))
    bucket = language_model._bucket(h, shift)
    assert got == Counter(zip(bucket.tolist(), (h >> np.uint64(shift - 32)).astype(np.uint32).tolist()))


def scored(n_blocks, some):
    """The function that scores, over a filter of all pairs in so many blocks, and its batch."""
    values, bounds = language_model.tokens([t.encode() for t in some])
    words, n = np.unique(values, return_counts=True)
    whole = language_model.Filter(0, 64, *(lambda b: (np.array([0, len(b)]), b))(language_model.bucket_bits(words, n)))
    two, m = np.unique(language_model._known_bits(language_model.pairs(values, bounds), 60), return_counts=True)
    cells = [language_model.bucket_bits(two[at], m[at]) for at in (language_model._bucket(two, 60) == i for i in range(16))]
    span = 16 // n_blocks

    def block(first):
        mine = cells[first : first + span]
        return Counted(first, 60, np.cumsum([0, *map(len, mine)]), np.concatenate(mine))

    blocks = [Block(lambda first=i * span: block(first)) for i in range(n_blocks)]
    run = language_model._scored(Frame(), [Block(lambda: (words, n, whole))], blocks, 60, int(n.sum()), len(words))
    ids, held = list(range(len(some))), [False] * len(some)
    return run, pa.RecordBatch.from_pydict({"doc_id": ids, "held_out": held, "text": some})


def test_scoring_holds_little_of_its_group_and_one_block():
    some = texts(150, 5_000)
    Block.most = 0
    run, batch = scored(16, some)
    # Sixteen blocks: all six megabytes are one group, of 750 000 pairs.
    assert peak(run, batch) < 750_000 * 64 + 40e6
    assert Block.most == 1


def test_scores_are_the_same_in_any_blocks_and_chunks(monkeypatch):
    some = [*texts(30, 300), "", "A b a B"]
    want = None
    for n_blocks, chunk in ((1, 1 << 20), (16, 1 << 20), (4, 5000)):
        monkeypatch.setattr(seq, "CHUNK", chunk)
        run, batch = scored(n_blocks, some)
        got = pa.Table.from_batches(list(run(iter([batch])))).to_pydict()
        want = want or got
        assert got == want
        assert got["doc_id"] == list(range(len(some))) and got["n_known"] == got["n_tokens"]
