"""What the trained skip chain adds to the patterns: entities that later come in a form no pattern knows."""

import dataclasses
import random

import numpy as np
import pytest

from edgeloom.llm import op4_pii
from llm_data import prose


def luhn_number(r):
    digits = [r.randrange(1, 10)] + [r.randrange(10) for _ in range(14)]
    return next(s for x in range(10) if op4_pii.luhn(s := "".join(map(str, digits)) + str(x)))


def planted(seed: int, n: int):
    """(text, words that are personal data in a form that no pattern finds) of ``n`` documents."""
    r, out = random.Random(seed), []
    for k in range(n):
        again, parts = [], [prose(seed * 1000 + k, r.randrange(5, 30))]
        area, local = f"{r.randrange(200, 999)}", f"{r.randrange(200, 999)}-{r.randrange(1000, 9999)}"
        kind = r.randrange(6)
        if kind == 0:  # a phone number, then without its country code
            parts += [f"call +1 ({area}) {local} now", prose(k, r.randrange(3, 25)), f"or just {area}-{local} later"]
            again = [f"{area}-{local}"]
        elif kind == 1:  # a card, then with other separators
            card = luhn_number(r)
            parts += [f"card {card} was charged", prose(k, r.randrange(3, 25)), f"see {card[:4]}.{card[4:8]}.{card[8:12]}.{card[12:]} please"]
            again = [f"{card[:4]}.{card[4:8]}.{card[8:12]}.{card[12:]}"]
        elif kind == 2:  # numbers that are nobody's, and come again
            order, item = r.randrange(10 ** 9, 10 ** 10), r.randrange(10 ** 14, 10 ** 15)
            parts += [f"order {order} of item {item}", prose(k, 9), f"and order {area}-{local} but not order {order} or item {item}"]
        elif kind == 3:  # both again as they were: the patterns find them twice
            card = luhn_number(r)
            parts += [f"call +1 ({area}) {local}", prose(k, 7), f"that is +1 ({area}) {local} for card {card}", prose(k, 5), f"so {card} it is"]
        else:  # a phone number, and an order's number like it
            parts += [f"call +1 ({area}) {local}", prose(k, 12), f"about order {r.randrange(10 ** 9, 10 ** 10)} again"]
        out.append((" ".join(parts), again))
    return out


def added(docs, crf):
    """Correct, all added, and planted spans."""
    right = made = wanted = 0
    for text, again in docs:
        base, every = op4_pii.find(text, crf)
        new = [text[a:z] for a, z, _ in every if (a, z) not in {(x, y) for x, y, _ in base}]
        right += len(set(new) & set(again))
        made += len(new)
        wanted += len(again)
    return right, made, wanted


@pytest.fixture(scope="module")
def trained(spark):
    return op4_pii.train(spark.createDataFrame([(t,) for t, _ in planted(1, 400)], "text string").repartition(4))


def test_the_trained_skip_chain_finds_what_the_shapes_do_not(trained):
    held_out = planted(2, 300)
    right, made, wanted = added(held_out, trained)
    assert wanted > 80 and right >= 0.9 * wanted and right >= 0.9 * made
    alone = dataclasses.replace(trained, skip=np.zeros_like(trained.skip))
    right, made, _ = added(held_out, alone)
    assert right <= 0.05 * wanted and made <= 0.05 * wanted


def test_skip_potentials_are_learned(trained):
    phone, card, none = op4_pii.LABELS.index("phone"), op4_pii.LABELS.index("card"), 0
    assert trained.skip[phone, phone] > 1 + trained.skip[phone, none] and trained.skip[none, none] > trained.skip[none, card]
    assert np.allclose(trained.skip, trained.skip.T)


def test_linked_tokens_without_a_label_are_hidden():
    text = "call +1 (243) 555-5526 today or 243-555-5526 but not 1234567890"
    t = op4_pii.tokens_of(text, op4_pii.base_spans(text))
    names = {text[a:z]: h for (a, z), h in zip(t.span, op4_pii.hidden(t), strict=True)}
    assert names == {"+1": False, "(243)": False, "555-5526": False, "243-555-5526": True, "1234567890": False}
