"""Plain Python versions of what the corpus operators must return."""

import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def spaced_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text, n=3):
    words = spaced_words(text)
    if not words:
        return frozenset()
    if len(words) < n:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def components(nodes, links):
    """Smallest node that links reach, by node position; ``nodes`` may repeat or be None."""
    parent = list(range(len(nodes)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    least = {}
    for i, node in enumerate(nodes):
        if node is not None:
            least[root(i)] = min(least.get(root(i), node), node)
    return [least.get(root(i)) for i in range(len(nodes))]


def jaccard_links(texts, percent=90, words=3):
    sets = [shingles(t, words) for t in texts]
    return [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
