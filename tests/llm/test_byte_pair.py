import gc
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from gondola.llm import byte_pair
from gondola.llm.queries import RANKS

PATH, PATTERN = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
TEXTS = ["", "Hello world", "a" * 700, "ab" * 400, "x  y \n\n z\t", "it's 'll ²½ 漢字 🎉\x1c\x85", " lead", "trail ", "\n", "!?" * 90]


@pytest.fixture(scope="module")
def library():
    vocabulary = byte_pair.Vocabulary(byte_pair.read_ranks(PATH))
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=vocabulary.ids, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return byte_pair.Encoder(byte_pair.read_ranks(PATH), PATTERN)


def random_texts(seed, number=3000):
    rnd = random.Random(seed)
    signs = [" ", "  ", "\n", "\t", "\r", "a", "the", "Th", "'s", "'ll", "1", "²", "é", "\xa0", " ", "!", "字", "x ", "́"]
    return ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 25))) for _ in range(number)]


def test_same_ids_as_the_library(encoder, library):
    texts = TEXTS + random_texts(3)
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), text
        assert encoder.decode(ids) == text.encode()


def test_rows_and_single_pieces_agree(encoder):
    rnd = random.Random(5)
    pieces = [bytes(rnd.choice(b"abcdeth r\xc3\xa9\x00") for _ in range(rnd.randint(1, 64))) for _ in range(500)]
    vocabulary = encoder.vocabulary
    assert [vocabulary.merge_rows([p])[0] for p in pieces] == [vocabulary.merge_long(p) for p in pieces]
    assert sum(map(len, vocabulary.merge(pieces))) > 0


def test_a_full_table_changes_nothing(encoder):
    small = byte_pair.Encoder(byte_pair.read_ranks(PATH), PATTERN, kept=5)
    for text in TEXTS + random_texts(4, 200):
        assert small.encode([text]) == encoder.encode([text])


def test_columns(spark, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, None), (1, "Hello world")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("made", F.lit(1)).withColumn("n_tokens", F.lit("x"))
    got = sorted(map(tuple, byte_pair.token_report(docs, PATH, PATTERN).collect()), key=str)
    want = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        packed = np.array(ids, "<u4").tobytes()
        want.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    ids = docs.select("text", byte_pair.encoded(spark, F.col("text"), PATH, PATTERN).alias("e")).select("text", "e.*")
    back = ids.select("text", "decoded", byte_pair.decode_ids(spark, F.col("ids"), PATH).alias("again")).collect()
    assert all(bytes(r.decoded) == bytes(r.again) == (r.text or "").encode() for r in back)
    assert byte_pair.token_report(docs.limit(0), PATH, PATTERN).count() == 0


def test_later_tasks_of_a_worker_find_no_tables(spark):
    docs = spark.createDataFrame([(i, "some text") for i in range(64)], "doc_id long, text string").repartition(8)
    assert byte_pair.token_report(docs, PATH, PATTERN).count() == 64
    byte_pair.token_report(docs, PATH, PATTERN).collect()

    def left(batches):
        for batch in batches:
            encoders = sum(type(o).__name__ == "Encoder" for o in gc.get_objects())
            yield pa.RecordBatch.from_pydict({"encoders": pa.array([encoders], pa.int32()), "collects": pa.array([gc.isenabled()])})

    got = spark.range(8, numPartitions=8).mapInArrow(left, "encoders int, collects boolean").collect()
    assert len(got) == 8 and {tuple(r) for r in got} == {(0, True)}
