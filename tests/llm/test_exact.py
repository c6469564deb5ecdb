"""Exactness and growth that the other tests don't reach: every character, texts full of hits, copies in the training sample."""

import time
import unicodedata
import zlib

import pytest

import public_tokenizers
from germlight.llm import characters, decontaminate, language_id, packed_ids, prefix_bpe

DOUBTFUL = characters.doubtful()
ALL = [chr(c) for c in (*range(1, 0xD800), *range(0xE000, 0x110000))]
#: All that some version of Unicode has a meaning for, and some of those that none has.
EVERY = [c for n, c in enumerate(ALL) if unicodedata.category(c) not in ("Cn", "Co") or c in DOUBTFUL or n % 64 == 0]
CONTEXTS = ("a{}a 1{}1 {} ", "{}{}b'{}s!{}\n")


def texts():
    for context in CONTEXTS:
        parts = [context.replace("{}", c) for c in EVERY]
        for at in range(0, len(parts), 4000):
            yield "".join(parts[at : at + 4000])


def test_packed_ids_of_every_character():
    encode = packed_ids.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for text in texts():
        assert encode(text).tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids


def test_bpe_of_every_character():
    """Pieces are compared by tiktoken's own ids: its encoding of the text against that of our pieces one by one."""
    import base64

    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = prefix_bpe.Vocabulary(ranks, public_tokenizers.PATTERN)
    for text in texts():
        assert own.encode(text) == library.encode_ordinary(text)


def test_pieces_of_other_patterns():
    """Numbers without a leading blank, three at most."""
    pattern = r"[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    own = prefix_bpe.Vocabulary({bytes([b]): b for b in range(256)}, pattern)
    assert own.pieces_of.table == prefix_bpe.Vocabulary({}, public_tokenizers.PATTERN).pieces_of.table


def test_texts_full_of_hits_take_time_in_proportion(spark):
    item = " ".join(f"w{i}" for i in range(20))
    items = spark.createDataFrame([(1, item)], "item_id long, text string")

    def seconds(times):
        docs = spark.createDataFrame([(1, " ".join([item] * times))], "doc_id long, text string")
        began = time.perf_counter()
        row = decontaminate.contaminated(docs, items).first()
        assert (row["n_words"], row["n_hit"], row["n_items"]) == (20 * times, 20 * times, 1)
        return time.perf_counter() - began

    seconds(100)
    short, long = seconds(1600), seconds(3200)
    assert long < 2.5 * short + 2
    assert seconds(32_000) < 90


def test_copies_leave_the_training_sample_whole(spark):
    rows = [(i, f"text number {i % 500} of the whole corpus " * 3, "en") for i in range(40_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = language_id.training_sample(docs)
    assert len(sample) == language_id.TRAIN_PER_LANGUAGE == len({part for _, part in sample})


@pytest.mark.parametrize("n", [3, 2000])
def test_distinct_texts_are_all_there(spark, n):
    docs = spark.createDataFrame([(i, f"text number {i} of the whole corpus", "en") for i in range(n)], "doc_id long, text string, lang string")
    learnt = {i for i in range(n) if zlib.crc32(str(i).encode()) % 5}
    assert len(language_id.training_sample(docs)) == min(len(learnt), language_id.TRAIN_PER_LANGUAGE)
