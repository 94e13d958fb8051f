"""Pages whose head is not closed."""

from __future__ import annotations

import numpy as np
import pytest

from shelfscout.llm import html

BODY = "<article><p>The first sentence of the main text.</p><p>And the second one, as long.</p></article>"


@pytest.mark.parametrize("start", [
    "<html><head><title>t</title><body>", "<html><head><meta charset=x><link rel=y><title>t</title>", "<head><script>var a = 1</script></head><body>",
    "<html><HEAD lang=en><style>p{}</style><noscript>no</noscript><body>", "<head>",
])
def test_main_text_after_the_head(start):
    assert html.main_text(start + BODY, np.zeros(html.FEATURES)) == "The first sentence of the main text.\nAnd the second one, as long."
