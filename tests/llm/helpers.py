"""Small fixtures and plain-Python twins of the contracts."""

import random
import re

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
                    for _ in range(n))


def frame(spark, texts, ids=None, schema="doc_id bigint, text string"):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame(list(zip(ids, texts)), schema).repartition(3)


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def spaced_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))


def rng(seed=7):
    return random.Random(seed)
