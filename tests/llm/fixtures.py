"""Small tables with every odd case: null in any column, empty and very long
texts, ties, repeated rows, no rows, and extra columns whose names clash with
those the operators use."""

import random

import public_tokenizers

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, "
          "n_words long, key long, fp long, bin long, row string, label int, sha binary, root long, `a.b` int, owner int")
N_EXTRA = 12
SYLLABLES = ["ba", "co", "du", "fé", "gi", "la", "mo", "ner", "ß", "que", "ra", "to", "the", "wi"]


def prose(rng: random.Random, words: int) -> str:
    out = []
    for k in range(words):
        w = "".join(rng.choices(SYLLABLES, k=rng.randint(1, 3)))
        out.append(w.capitalize() + "." if rng.random() < 0.1 else w)
        out.append("\n" if rng.random() < 0.05 else " ")
    return "".join(out).strip()


def texts(seed: int = 0, n: int = 60) -> list:
    rng = random.Random(seed)
    out = [None, "", " ", " \n\t ", "one", "one two", "a  b ", "▁x \x02 \x1c <|endoftext|> <s>   中\U0001f600",
           "x" * 3000, "same words " * 400, prose(rng, 9000), "\n".join(["line one two three four five six seven"] * 9)]
    base = prose(rng, 200)
    out += [base, base, base + " tail", base.replace(" ", "\n"), base.replace(" ", "  "), base.upper()]
    out += [prose(rng, rng.randint(1, 300)) for _ in range(n)]
    return out


def row(doc_id, text):
    return (doc_id, text, None, None, None, *[None] * N_EXTRA)


def edge_rows(seed: int = 0, n: int = 60) -> list:
    rows = [row(k, t) for k, t in enumerate(texts(seed, n))]
    rows += [row(7, rows[7][1]), rows[20], rows[20], row(20, "another text under a known id"),
             row(None, "a text without an id"), row(None, None), row(-5, rows[15][1]), row(10 ** 12, "one")]
    return rows


def docs(spark, rows=None):
    return spark.createDataFrame(edge_rows() if rows is None else rows, SCHEMA)


def labels(spark, rows=None):
    if rows is None:
        rows = [(k, k % 3 and 1, int(k % 4 == 0)) for k in range(0, 70)] + [
            (3, None, None), (None, 1, 1), (4, 0, 1), (4, 1, 0), (999, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def pairs(rows) -> list:
    """(doc_id, text) of fixture rows, a null text as empty."""
    return [(r[0], r[1] or "") for r in rows]
