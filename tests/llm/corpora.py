"""Small corpora with the odd rows that every operator has to take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b + c for a in ("th", "er", "on", "in", "st") for b in ("a", "e", "o", "ou") for c in ("n", "r", "s", "tion")]


def prose(rng, n, line=12):
    words = [rng.choice(WORDS) + rng.choice(["", "", "", ",", "."]) for _ in range(n)]
    return "\n".join(" ".join(words[i:i + line]) for i in range(0, n, line))


def corpus(seed=1, docs=60):
    """(doc_id, text): prose with exact copies, near copies, shared passages, empty, null and repeated rows."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(3, 160)) for _ in range(docs)]
    passage = prose(rng, 60)
    for i in range(5):
        texts.append(prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 40))
    base = prose(rng, 120)
    for _ in range(12):
        words = base.split(" ")
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        texts.append(" ".join(words))
    texts += [texts[0], texts[0].replace(" ", "  "), texts[0] + " ", "", None, " \t\n", "one", "ONE", "Ünï ßé 😀 x", "a " * 4000]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return rows + [rows[3], rows[3], (None, texts[1]), (None, None)]
