import random

import public_tokenizers

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

# Columns that operators use inside, on top of those of documents.
CLASHING = ("kept", "fp", "component_id", "_first", "_text_key", "_found_id", "_found_key", "lines",
            "_lines", "hit", "_hit", "n_found", "_hits", "hash", "shard", "words", "line", "first")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          + ", ".join(f"`{c}` string" for c in CLASHING))


def prose(seed, words=80):
    """Text of invented words, the same for the same seed."""
    dice = random.Random(seed)
    out = []
    for k in range(words):
        word = "".join(dice.choice("aeioubcdfglmnprst") for _ in range(dice.randint(2, 8)))
        out.append(word + ("\n" if k % 12 == 11 else " "))
    return "".join(out).strip()


def line_of(seed, words):
    return prose(seed, words).replace("\n", " ")


def documents(spark, rows):
    """A table of documents of (doc_id, text) pairs, with columns of clashing names."""
    return spark.createDataFrame(
        [(i, t, "en", "s", len(t) if t is not None else None, *CLASHING) for i, t in rows], SCHEMA)
