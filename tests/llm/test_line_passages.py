from __future__ import annotations

import random

from test_line_dedup import sentence

from siltgate.llm import line_dedup


def test_short_passages_go_whole(spark, staging):
    """Passages of 1 to 5 lines and 50 words or a few more, also of very uneven lines."""
    draw = random.Random(5)
    passages = [" ".join(sentence(draw, -(-52 // n)) for _ in range(n)) for n in range(1, 6) for _ in range(6)]
    uneven = " ".join(sentence(draw, n) for n in (1, 2, 24, 1, 23, 2, 1))
    passages += [uneven, uneven.replace(" ", "\t")]
    docs = []
    for n in range(4 * len(passages)):
        own = [" ".join(sentence(draw, draw.randrange(4, 15)) for _ in range(4)) for _ in range(6)]
        own.insert(draw.randrange(7), passages[n % len(passages)])
        docs.append((n, "\n".join(own)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = line_dedup.remove_repeated_chunks(df, staging)
    out = {r.doc_id: r.text for r in found.collect()}
    for n, text in docs:
        passage = passages[n % len(passages)]
        if n < len(passages):
            assert out[n] == text
        else:
            assert "".join(out[n].split()) == "".join(text.replace(passage, "").split())
