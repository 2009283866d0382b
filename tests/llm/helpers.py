"""Random text and tables for the tests of the text operators."""

WORDS = [a + b for a in ("ka", "lo", "mi", "né", "ru", "st") for b in ("", "n", "ra", "tho", "wé", "zil")]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(300)) for _ in range(n))


def prose(rng, sentences=6, words=9):
    return " ".join(sentence(rng, words).capitalize() + "." for _ in range(sentences))


def clashing(docs, *names):
    """``docs`` with more columns, called as the operator calls its own."""
    for name in names:
        docs = docs.selectExpr("*", f"'theirs' AS `{name}`")
    return docs
