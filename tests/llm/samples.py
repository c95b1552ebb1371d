"""Rows that every operator has to take."""

import random

#: Extra columns with the names that operators use for their own.
CLASHES = ("key", "h", "size", "file", "row", "kept", "digest", "p0", "node", "root", "shard", "batch", "tokens", "slot",
           "length", "start", "state", "n", "bucket", "cuts", "trusted", "total", "host", "path", "dim", "ids", "v")


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(["tide", "Mark", "salt,", "over", "grey.", "stone", "wind", "rose", "to", "the", "harbour", "1912"])
                    + (rng.choice("abcdefgh") if rng.random() < 0.5 else "") for _ in range(n))


def awkward_rows() -> list[tuple]:
    rows = [(i, prose(i, 20 + 7 * i), ["en", "de"][i % 2], f"s{i % 4}") for i in range(30)]
    rows += [(100 + i, prose(3, 41), "en", "s0") for i in range(9)]  # exact copies of document 3
    rows += [(200, None, "en", "s1"), (201, "", "en", None), (202, " \n\t ", None, "s2"), (203, "one", "fr", None),
             (204, prose(77, 9000), "en", "s3"), (205, prose(8, 76) + " but a few more words", "en", "s3"),
             (206, "a\x1eb  c \n x <|endoftext|> é 日本語 　 <s>", "xx", "")]
    rows += [(5, prose(5, 55), "de", "s1")]  # a row that repeats
    rows += [(300 + i, "the " * 400, "en", "s2") for i in range(3)]
    return rows
