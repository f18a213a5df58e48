import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def words(text, lower=False):
    return WORD.findall((text or "").translate(LOWER) if lower else text or "")


def frame(spark, rows, extra=True):
    """Documents (doc_id, text), with columns whose names could clash."""
    schema = "doc_id long, text string" + (", block int, shard string, n long, node string, words string" if extra else "")
    return spark.createDataFrame([(*r, 7, "x", None, "y", "z") if extra else r for r in rows], schema)


def corpus(seed, n=60, size=80, vocabulary=400):
    """Random texts with exact copies, near copies, repeated passages, short and odd texts."""
    rng = random.Random(seed)
    known = [f"w{i}" for i in range(vocabulary)]
    passage = rng.choices(known, k=50)
    out = []
    for i in range(n):
        kind = i % 6
        text = rng.choices(known, k=rng.randint(1, size))
        if out and kind == 1:
            text = rng.choice(out).split()
        elif out and kind == 2:
            text = rng.choice(out).split()
            for _ in range(rng.randint(1, 3)):
                if text:
                    text[rng.randrange(len(text))] = rng.choice(known)
        elif kind == 3:
            at = rng.randint(0, len(text))
            text = text[:at] + passage + text[at:]
        elif kind == 4:
            text = rng.choices(known[:2], k=rng.randint(1, 90))
        out.append(rng.choice([" ", "  ", "\n"]).join(text))
    return [(i, t) for i, t in enumerate(out)] + [(900, None), (901, ""), (902, " \t\n"), (903, "Élan"), (904, "élan"), (5, out[5]), (5, out[5]), (None, "only here a null id"), (None, out[0])]
