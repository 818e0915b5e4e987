import random

import pytest

from pagewright.llm import abuse

BAD = ["You are a worthless idiot and I will break your hands", "Those strangers are vermin and should be driven out", "Send me your naked pictures right now"]
KIND = ["abusive", "hateful", "sexual"]
TRAP = ["Keep every naked flame away from the valve.", "The idiot light on the panel was on.", "Training covers abusive words."]


@pytest.fixture
def corpus(spark, prose):
    r = random.Random(0)
    docs, labels = [], []
    for i in range(240):
        parts = [prose(i * 3 + k, 12) + "." for k in range(3)] + [r.choice(TRAP)]
        kind = i % 4 - 1
        if kind >= 0:
            parts.insert(r.randrange(3), BAD[kind] + "!")
        docs.append((i, " ".join(parts), 1.0))
        if i < 160:
            labels.append((i, KIND[kind] if kind >= 0 else "none", "r1"))
    docs += [(900, None, 1.0), (901, "", 1.0), docs[0]]
    labels += [labels[0], (5, "none", "r2"), (9999, "abusive", "r1"), (None, "none", "r1")]
    return spark.createDataFrame(docs, "doc_id bigint, text string, score double"), spark.createDataFrame(labels, "doc_id bigint, label string, reviewer string")


def test_held_out_documents_and_passages(corpus):
    docs, labels = corpus
    rows = {r["doc_id"]: r for r in abuse.score(docs, abuse.fit(docs, labels, kinds=True)).collect()}
    assert len(rows) == 242 and rows[900]["score"] == rows[901]["score"] == 0
    held = [i for i in range(160, 240)]
    right = sum((rows[i]["score"] >= 0.5) == (i % 4 != 0) for i in held)
    assert right >= 76
    assert sum(any(b.split()[2] in rows[i]["passage"] for b in BAD) for i in held if i % 4) >= 50
    assert sum(max(KIND, key=lambda k: rows[i][k]) == KIND[i % 4 - 1] for i in held if i % 4) >= 50  # noqa: B023


def test_without_labels_nothing_is_found(spark, corpus):
    docs, labels = corpus
    assert abuse.score(docs, abuse.fit(docs, labels.limit(0))).where("score >= 0.5").count() == 0
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert abuse.score(empty, abuse.fit(empty, labels)).count() == 0


def test_disguises():
    assert abuse.plain_words("You sTuPiD 1di0t") == ["you", "stupid", "idiot"]
    assert abuse.plain_words("iiidiooot f**l") == ["idiot", "f*l"]
    assert abuse.passages("an i-d-i-o-t here. And a f o o l too") == ["an idiot here", "And a fool too"] or abuse.passages("an i-d-i-o-t here.") == ["an idiot here"]
    assert abuse.plain_words("TX0541Q 12 Müßig") == ["code", "0", "mussig"]
