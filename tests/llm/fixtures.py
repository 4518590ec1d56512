"""Small documents with every awkward case, and brute-force versions of the operators."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, m string, kept string, path string"
WORDS = "the and of that with from this have been which their would about other into more some time these only".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "ly", "ing", "ed"]) for _ in range(n))


def document(rng, lines=6, words=9):
    return "\n".join(sentence(rng, words + rng.randrange(4)).capitalize() + "." for _ in range(lines))


def rows(n=60, seed=5):
    """Random documents with exact and near copies, shared lines, nulls, empty and long texts."""
    rng = random.Random(seed)
    texts = [document(rng) for _ in range(n)]
    shared = sentence(rng, 14)
    for i in range(0, n, 7):
        texts[i] += "\n" + shared + (" indeed" if i % 2 else "")
    base = document(rng, 12)
    texts += [base] * 4
    for i in range(8):
        words = base.split(" ")
        words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    texts += [None, None, "", " \n ", "one", "one two three", "one two three", "Éa ñ 漢字 😀 é", "x" * 3000, "\n".join([shared] * 3)]
    texts.append(" ".join(document(rng, 40) for _ in range(10)))
    langs, sources = ["en", "de", None], ["a", "a", "a", "b", None]
    out = [(i, t, langs[i % 3], sources[i % 5], None if t is None else len(t), "m", "k", "p") for i, t in enumerate(texts)]
    out.append((None, texts[0], "en", "a", None, None, None, None))
    out.append((None, None, None, None, None, None, None, None))
    out.append(out[3])  # a repeated row
    return out


def groups(ids, links):
    """The smallest member of each id's connected group."""
    parent = {i: i for i in ids}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}
