"""Tag lists. The output text depends on them."""

# Each edge of these elements is a line break.
BLOCK_TAGS = (
    "address", "article", "aside", "blockquote", "br", "dd", "div", "dl", "dt",
    "figcaption", "figure", "footer", "h1", "h2", "h3", "h4", "h5", "h6", "header",
    "li", "main", "nav", "ol", "p", "pre", "section", "table", "td", "th", "tr", "ul",
)

# Text inside these elements is never shown.
SKIP_TAGS = ("script", "style", "noscript", "svg", "template")

# Elements without an end tag.
VOID_TAGS = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
    "source", "track", "wbr",
)
