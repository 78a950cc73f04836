"""Plain one-step-at-a-time versions of the jobs, for comparison on small inputs."""

from collections import Counter

import regex

from tokenloom.functions.text import PRETOKEN_PATTERN


def pretokens(text):
    return regex.findall(PRETOKEN_PATTERN, text)


def merge(word, pair, new):
    out, i = [], 0
    while i < len(word):
        if tuple(word[i : i + 2]) == pair:
            out.append(new)
            i += 2
        else:
            out.append(word[i])
            i += 1
    return out


def train(texts, n_merges):
    """Merges as byte pairs, one at a time, greatest (count, left, right) first."""
    counts = Counter(p for text in texts for p in pretokens(text))
    words = [([bytes([b]) for b in p.encode()], n) for p, n in counts.items()]
    merges = []
    for _ in range(n_merges):
        pairs = Counter()
        for word, n in words:
            for pair in zip(word, word[1:]):
                pairs[pair] += n
        if not pairs:
            break
        best = max(pairs, key=lambda pair: (pairs[pair], pair))
        merges.append(best)
        words = [
            (merge(word, best, best[0] + best[1]) if best[0] in word else word, n)
            for word, n in words
        ]
    return merges


def encode_word(data, ids, merges):
    """Lowest rank first; a whole word in the vocabulary is taken as it is."""
    if data in ids:
        return [ids[data]]
    ranks = {pair: rank for rank, pair in enumerate(merges)}
    word = [bytes([b]) for b in data]
    while True:
        found = [ranks[pair] for pair in zip(word, word[1:]) if pair in ranks]
        if not found:
            return [ids[token] for token in word]
        pair = merges[min(found)]
        word = merge(word, pair, pair[0] + pair[1])


def split_specials(text, specials):
    if not specials:
        return [(text, False)] if text else []
    pattern = "|".join(regex.escape(s) for s in sorted(specials, key=len, reverse=True))
    parts = regex.split(f"({pattern})", text)
    return [(part, part in specials) for part in parts if part]


def encode(text, ids, merges, specials=()):
    out = []
    for part, special in split_specials(text, specials):
        if special:
            out.append(ids[part.encode()])
        else:
            for word in pretokens(part):
                out += encode_word(word.encode(), ids, merges)
    return out
