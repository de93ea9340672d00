"""Helpers of the operators' tests."""

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Names that operators use inside.
CLASHES = ["size", "taken", "id", "_id", "_row", "_key", "_plan", "quota", "n", "bucket", "band", "part", "sig", "line", "removed", "root",
           "class", "bin", "rank", "shard", "slot", "passes", "_text", "_p", "base", "v", "ids", "links", "a b", "x.y"]


def prose(rng, words, letters="abcdefghij"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(words))


def same(a, b):
    """Equal as multisets of rows."""
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
