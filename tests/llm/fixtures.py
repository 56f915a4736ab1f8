"""Small tables with every awkward case, and brute-force versions of the operators."""

from __future__ import annotations

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = ("the and of to in that it was for on with as by at from her his they be this have not are but had which she all were "
         "there been their one said when who will more no if out so up what into about them can only other new some could time "
         "these two may then do first any my now such like our over man me even most made after also did many before must").split()


def prose(rng: random.Random, n: int) -> str:
    out = []
    for i in range(n):
        w = "".join(rng.choice(WORDS) for _ in range(rng.randint(1, 3)))
        out.append(w.capitalize() if i % 11 == 0 else w + ("." if i % 11 == 10 else ""))
    return " ".join(out)


def edited(rng: random.Random, text: str, share: float) -> str:
    words = text.split(" ")
    for _ in range(int(len(words) * share)):
        words[rng.randrange(len(words))] = "changed" + str(rng.randrange(1000))
    return " ".join(words)


def texts() -> list:
    """Texts of a small corpus: prose, copies, near copies, junk, nulls, empties, a very long one."""
    rng = random.Random(11)
    base = [prose(rng, rng.randint(60, 300)) for _ in range(40)]
    out: list = list(base)
    out += [base[0], base[0].replace(" ", "  \n\t"), base[1].replace(" ", "\x0b"), base[2] + " ", base[2].upper()]
    out += [edited(rng, base[i], s) for i in range(3, 13) for s in (0.01, 0.02, 0.04, 0.3)]
    out += [None, None, "", " ", "\n \t\r\n", "a", "a b c", "A B c", "a b c", "one two three four", "ONE two three four"]
    out += ["same words here " * 60, "buy now " * 300, "#*$%&|<> " * 80, "x" * 5000]
    out += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(60)) + " " for _ in range(1)]
    out += ["日本語のテキスト 123 ４５ é ü ñ \u0085   \x1c x\x00y <|endoftext|> don't we'll", "  lead   and  trail  ", "a\n\n b \n c  \n"]
    out += [prose(rng, 30_000), "line one is here\n" * 3 + "\n\n" + prose(rng, 80) + "\nline one is here"]
    return out


def doc_rows() -> list[tuple]:
    rows = [(i * 3 + 1, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts())]
    return rows + [rows[0], rows[0], rows[43], (None, rows[5][1], "en", "s0", 1), (None, None, None, None, None), (None, None, None, None, None)]


def documents(spark, rows=None):
    return spark.createDataFrame(doc_rows() if rows is None else rows, DOCS)


def clashing(docs):
    """The same documents with extra columns named like the operators' own."""
    from pyspark.sql import functions as F

    extra = ["kept", "digest", "norm", "salt", "ids", "score", "features", "component_id", "block", "h", "key", "row", "start"]
    return docs.select("*", *[F.lit(f"extra {c}").alias(c) for c in extra])
