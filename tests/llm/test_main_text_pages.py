"""Pages whose parts the features and the reader must not lose."""

import numpy as np

from accrual.llm.main_text import Page, features

PLACE, ALIKE, LEFT, RIGHT = 20, 21, 26, 27


def test_places_among_many_siblings():
    """Siblings with nested blocks, some of another tag, on a short and on a long page."""
    for count in (10, 63, 64, 65, 400):
        inner = [f"<div><p>{'x' * (i + 1)}</p><p>y</p></div>" if i % 4 else f"<section>{'x' * (i + 2)}</section>" for i in range(count)]
        page = Page("".join(inner))
        rows, tops = features(page), page.nodes[0].children
        tags = [page.nodes[at].tag for at in tops]
        sizes = np.log1p(np.arange(count) + 2)
        whole = np.log1p((np.arange(count) + 2).sum())
        assert len(tops) == count
        assert np.allclose(rows[tops, PLACE], np.arange(count) / count)
        assert np.allclose(rows[tops, ALIKE], [tags.count(t) / count for t in tags])
        assert np.allclose(rows[tops, LEFT], [whole, *sizes[:-1]])
        assert np.allclose(rows[tops, RIGHT], [*sizes[1:], whole])


def blocks(html):
    return [t for _, t in Page(html).blocks]


def test_embedded_text_is_read():
    page = (
        "<head><title>no</title><noscript><img src=x></noscript><style>no</style></head><article>"
        "<p>As <math><mi>a</mi><mo>=</mo><mn>2</mn></math> and <svg><title>no</title><text>b</text></svg> show.</p>"
        "<object data=x><p>Fallback</p></object><p>c <object>d</object> e</p><canvas>f</canvas><iframe>g</iframe>"
        "<noscript>h</noscript><script>no</script><template><div>no<template>no</template>no</div></template><p>i</p></article>"
    )
    assert blocks(page) == ["As a=2 and b show.", "Fallback", "c", "d", "e", "f", "g", "h", "i"]


def test_unclosed_elements_end_with_their_block():
    for tag in ("math", "svg", "object", "canvas", "iframe", "noscript"):
        assert blocks(f"<div><p>a</p><{tag}>b</div><p>c</p>") == ["a", "b", "c"]
    assert blocks("<div><p>a</p><template><div>no</div><p>no</div><p>c</p>") == ["a", "c"]
    assert blocks("<div><p>a</p><svg><title>no</div><p>c</p>") == ["a", "c"]
    assert blocks("<head><noscript><div>a</div><p>b</p>") == ["a", "b"]
    assert len(Page("<div><p>a</p><iframe/><object/><p>b</p></div>").nodes) == 4
