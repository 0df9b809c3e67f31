"""Rows and plain helpers of the tests of this folder."""

LONG = "lorem ipsum dolor sit amet " * 8000 + "x" * 5000

#: doc_id, text, lang, source: nulls, blanks, repeats, ties, long texts, control strings, marks of other alphabets.
EDGE = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a"),
    (3, None, "en", "a"),
    (4, "", None, None),
    (5, " \n\t ", "de", "b"),
    (6, LONG, "de", "b"),
    (7, "a\n  b\n\nb c  ", "fr", "b"),
    (8, "日本語 テキスト 𝄞 ñandú <|endoftext|> </s> ▁x", "es", "c"),
    (9, "one two three one two three one two three", None, "c"),
    (None, "no id at all here", "en", "c"),
    (None, "no id at all here", "en", None),
    (10, "word", "en", "c"),
    (-5, "A B c d e f g h\nA B c d e f g h\n#*$ |", "en", "d"),
    (2**62, "The quick brown fox jumps over the lazy dog near the river bend", "en", "d"),
]
CLASH = ["fp", "stats", "range", "copy", "keep_p", "score", "component_id", "cell_source", "piece_ids", "failed", "label", "tie"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASH)


def rows_of(docs):
    return [(d, t, l, s, None if t is None else len(t), *[f"{c}-{i}" for c in CLASH]) for i, (d, t, l, s) in enumerate(docs)]


def unions(nodes, edges):
    """Smallest member of each node's component, in order of the nodes."""
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return [top(n) for n in nodes]
