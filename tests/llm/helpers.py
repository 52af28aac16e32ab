"""Small tables with the awkward rows that every operator must take, and brute-force versions."""

from __future__ import annotations

import random
import re
from functools import lru_cache

import public_tokenizers
from tokenizers import Tokenizer

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")

DOCS_SCHEMA = "doc_id long, text string, row long, words array<string>, hits string, sketch int, `odd name` string"


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def alnum_words(text):
    return ALNUM.findall(ascii_lower(text))


def spaced_words(text):
    return SPACED.findall(ascii_lower(text))


def with_clashing_columns(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, 1, ["x"], None, 3, "y") for i, t in rows], DOCS_SCHEMA)


def prose(seed, n):
    rng = random.Random(seed)
    vocabulary = ["alpha", "bétà", "the", "Of", "and", "stone", "x1", "Ωmega", "run", "café", "blue", "seven", "tree", "Wind"]
    return " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ",", ".", "\n"]) for _ in range(n))


@lru_cache
def library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def library_ids(name, texts):
    tokenizer = library(name)
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "One two."),
    (None, "a text without an id, of some words"),
    (None, None),
    (7, "twice the same row"),
    (7, "twice the same row"),
    (7, "the same id, another text"),
    (8, "odd \x1c signs \x00 and  spaces 　 here \U0001f600"),
]
