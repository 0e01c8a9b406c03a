"""Token counts that follow edits, with trees that are kept.

A document is a balanced tree of leaves; a leaf is a run of pre-tokens, of some ``SPAN`` characters, with its characters and
tokens, an inner node has the sums of its subtrees. The splitting pattern reads from left to right, keeps
nothing from one part to the next and looks at most one character past a part, so cutting at the end of a
part changes nothing on either side, unless white space is split there; no leaf ends in white space but
the last. A letter before a space and a letter ends a part whatever stands around it, so leaves end there; where none is
near, the pattern itself finds the end. An edit takes out the leaves that it touches, from the
first that ends less than two characters before it, and extends to the right until the end of a leaf is
again the end of a part; only these are encoded again, and only sums on their paths are made anew.

``plant`` makes a table of documents with their trees, to be written and kept; ``edit`` applies edits to a kept table, ``renew``
brings new versions of documents to one: where a text is the kept one nothing is encoded, where it differs only what lies
between the parts that both begin and end with. Both return the table to keep next. Leaves are kept as numbers of
characters and tokens, in order.

Defined results: null text is empty (0 tokens); edits run in their order, each on the text that the last
left; places are code points, clipped to the text, and an end before its start is the start; null places
are 0, null replacements empty, null edits and edit lists nothing; repeated rows are documents of their
own (of a repeated key, ``renew`` goes on from one kept row); a null key is no document that is kept; an empty table gives no rows; other
columns pass through, but for those with a result's name, which gives way to it. Texts have any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from os.path import commonprefix

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ._shared import hidden, shown, small_batches, trimmed
from .bytebpe import PARTS, Encoder, vocabulary

LEAF = 64
SPAN = 320
PEEK = 8
_END = regex.compile(r"\p{L}(?= \p{L})")
TREE = "struct<text:string,chars:array<int>,tokens:array<int>>"
EDITS = "array<struct<start:bigint,end:bigint,text:string>>"


@dataclass(slots=True)
class Node:
    """A leaf has text, an inner node two subtrees."""

    chars: int
    tokens: int
    height: int = 0
    text: str = ""
    left: Node | None = field(default=None, repr=False)
    right: Node | None = field(default=None, repr=False)


def _over(a: Node, b: Node) -> Node:
    return Node(a.chars + b.chars, a.tokens + b.tokens, 1 + max(a.height, b.height), "", a, b)


def _balanced(a: Node, b: Node) -> Node:
    """A node over two trees whose heights differ by at most two."""
    if a.height > b.height + 1:
        if a.left.height >= a.right.height:
            return _over(a.left, _over(a.right, b))
        return _over(_over(a.left, a.right.left), _over(a.right.right, b))
    if b.height > a.height + 1:
        if b.right.height >= b.left.height:
            return _over(_over(a, b.left), b.right)
        return _over(_over(a, b.left.left), _over(b.left.right, b.right))
    return _over(a, b)


def join(a: Node | None, b: Node | None) -> Node | None:
    if a is None or b is None:
        return a or b
    if a.height > b.height + 1:
        return _balanced(a.left, join(a.right, b))
    if b.height > a.height + 1:
        return _balanced(join(a, b.left), b.right)
    return _over(a, b)


def cut(tree: Node | None, at: int) -> tuple[Node | None, Node | None]:
    """Leaves that end at or before ``at``, and the rest."""
    if tree is None:
        return None, None
    if tree.left is None:
        return (tree, None) if tree.chars <= at else (None, tree)
    if at < tree.left.chars:
        a, b = cut(tree.left, at)
        return a, join(b, tree.right)
    a, b = cut(tree.right, at - tree.left.chars)
    return join(tree.left, a), b


def leaves(tree: Node | None) -> Iterator[Node]:
    stack = [tree] if tree else []
    while stack:
        node = stack.pop()
        if node.left is None:
            yield node
        else:
            stack += [node.right, node.left]


def cuts(text: str) -> Iterator[str]:
    """The text in leaves."""
    at, n = 0, len(text)
    while at < n:
        end = n
        if n - at > 2 * SPAN:
            m = _END.search(text, at + SPAN, at + 2 * SPAN)
            if m:
                end = m.end()
            else:
                for k, m in enumerate(PARTS.finditer(text, at)):
                    if k >= LEAF and not text[m.end() - 1].isspace():
                        end = m.end()
                        break
        yield text[at:end]
        at = end


def _tree(row: list[Node]) -> Node | None:
    while len(row) > 1:
        row = [join(row[i], row[i + 1]) if i + 1 < len(row) else row[i] for i in range(0, len(row), 2)]
    return row[0] if row else None


class Counted:
    """A text and its number of tokens; ``encoded`` counts the characters that were given to the coder."""

    def __init__(self, text: str, coder: Encoder, kept: tuple[list[int], list[int]] | None = None):
        """kept: the leaves' characters and tokens, where the text has been counted before."""
        self._coder, self.encoded = coder, 0
        if kept is None:
            self.tree = self._build(text)
            return
        row, at = [], 0
        for chars, tokens in zip(*kept, strict=True):
            row.append(Node(chars, tokens, 0, text[at : at + chars]))
            at += chars
        self.tree = _tree(row)

    def kept(self) -> dict:
        row = list(leaves(self.tree))
        return {"text": "".join(n.text for n in row), "chars": [n.chars for n in row], "tokens": [n.tokens for n in row]}

    @property
    def tokens(self) -> int:
        return self.tree.tokens if self.tree else 0

    @property
    def chars(self) -> int:
        return self.tree.chars if self.tree else 0

    def text(self) -> str:
        return "".join(n.text for n in leaves(self.tree))

    def _build(self, text: str) -> Node | None:
        self.encoded += len(text)
        return _tree([Node(len(s), self._coder.count(s), 0, s) for s in cuts(text)])

    def become(self, text: str) -> None:
        """The text now is this one: an edit of what lies between the parts that both begin and end with."""
        old = self.text()
        if old == text:
            return
        first = len(commonprefix([old, text]))
        most = min(len(old), len(text)) - first
        last = len(commonprefix([old[len(old) - most :][::-1], text[len(text) - most :][::-1]]))
        self.edit(first, len(old) - last, text[first : len(text) - last])

    def edit(self, start: int, end: int, text: str) -> None:
        start = min(max(start, 0), self.chars)
        end = min(max(end, start), self.chars)
        before, rest = cut(self.tree, max(0, start - 2))
        at = before.chars if before else 0
        old, after, piece = "", rest, ""
        while after is not None and at + len(old) < max(end, at + 1):
            first, after = self._first(after)
            old += first.text
        piece = old[: start - at] + text + old[end - at :]
        while after is not None and not self._ends_part(piece, after):
            first, after = self._first(after)
            piece += first.text
        self.tree = join(join(before, self._build(piece)), after)

    @staticmethod
    def _first(tree: Node) -> tuple[Node, Node | None]:
        node = tree
        while node.left is not None:
            node = node.left
        return node, cut(tree, node.chars)[1]

    def _ends_part(self, piece: str, after: Node) -> bool:
        if piece[-1:].isspace():
            return False
        peek = ""
        for leaf in leaves(after):
            peek += leaf.text[:PEEK]
            if len(peek) >= PEEK:
                break
        at = 0
        for m in PARTS.finditer(piece + peek):
            at = m.end()
            if at >= len(piece):
                break
        return at == len(piece)


def with_edits(docs: DataFrame, edits: DataFrame, key: str = "doc_id") -> DataFrame:
    """docs with a column ``edits``: those of the table (key, seq, start, end, text), in order of seq."""
    each = F.struct("seq", F.struct(F.col("start").cast("long"), F.col("end").cast("long"), F.col("text").cast("string")).alias("e"))
    per = edits.groupBy(F.col(key).alias("__key")).agg(F.sort_array(F.collect_list(each)).alias("__edits"))
    joined = docs.join(per, docs[key] == per["__key"], "left").drop("__key")
    return joined.withColumn("edits", F.col("__edits.e").cast(EDITS)).drop("__edits")


def _counted(df: DataFrame, file: str, inner: list[str], then: str | None, keep: bool) -> DataFrame:
    """Rows with __tree (kept, or null), __text and __edits -> the inner columns, what was counted, and __tree if it is to be kept.

    then: "edits", or "text" for new versions, or nothing.
    """
    fields = [f for f in df.schema.fields if f.name in inner]
    counts = [T.StructField(c, T.LongType()) for c in ("__n", "__after", "__chars", "__encoded")]
    schema = T.StructType([*fields, *counts, *([T.StructField("__tree", T.StructType.fromDDL(f"t {TREE}")[0].dataType)] if keep else [])])
    arrow = to_arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(file)
        for b in batches:
            got, trees = [], []
            for k in range(len(b)):
                tree = b.column("__tree")[k].as_py() if "__tree" in b.schema.names else None
                text = (b.column("__text")[k].as_py() or "") if "__text" in b.schema.names else ""
                doc = Counted(text, coder) if tree is None else Counted(tree["text"], coder, (tree["chars"], tree["tokens"]))
                n = doc.tokens
                if then == "text" and tree is not None:
                    doc.become(text)
                elif then == "edits":
                    for e in b.column("__edits")[k].as_py() or ():
                        if e is not None:
                            doc.edit(e["start"] or 0, e["end"] or 0, e["text"] or "")
                got.append((n, doc.tokens, doc.chars, doc.encoded))
                if keep:
                    trees.append(doc.kept())
            columns = [b.column(f.name) for f in fields] + [pa.array(c, pa.int64()) for c in (zip(*got, strict=True) if got else [()] * 4)]
            yield pa.RecordBatch.from_arrays([*columns, *([pa.array(trees, arrow.field("__tree").type)] if keep else [])], schema=arrow)

    return df.mapInArrow(trimmed(read), schema)


def plant(docs: DataFrame, *, text: str = "text", tokenizer: str | None = None, carry: list[str] | None = None) -> DataFrame:
    """The carried columns (all, by default), n_tokens and ``tree`` of every row: a table to keep."""
    small_batches(docs.sparkSession)
    cols, pairs = hidden(docs, carry if carry is not None else docs.columns)
    made = _counted(docs.select(*cols, docs[f"`{text}`"].cast("string").alias("__text")), tokenizer or vocabulary(), [i for i, _ in pairs], None, True)
    return made.select(*shown(pairs, "n_tokens", "tree"), F.col("__n").alias("n_tokens"), F.col("__tree").alias("tree"))


def edit(kept: DataFrame, edits: str = "edits", *, tokenizer: str | None = None, carry: list[str] | None = None, keep: bool = True) -> DataFrame:
    """kept: what ``plant`` made, with an array column of structs (start, end, text) -> the carried columns, n_tokens,
    n_tokens_edited, n_chars_edited, n_chars_encoded (for the edits) and, with ``keep``, the tree after them."""
    small_batches(kept.sparkSession)
    cols, pairs = hidden(kept, carry if carry is not None else [c for c in kept.columns if c not in ("tree", "n_tokens", edits)])
    asked = kept.select(*cols, kept["tree"].cast(TREE).alias("__tree"), kept[f"`{edits}`"].cast(EDITS).alias("__edits"))
    return _named(_counted(asked, tokenizer or vocabulary(), [i for i, _ in pairs], "edits", keep), pairs, keep)


def renew(docs: DataFrame, kept: DataFrame, key: str = "doc_id", *, text: str = "text", tokenizer: str | None = None, carry: list[str] | None = None, keep: bool = True) -> DataFrame:
    """docs: new versions of documents, some of them kept -> as ``edit``; n_tokens is that of the kept text, or of a new document's own."""
    small_batches(docs.sparkSession)
    cols, pairs = hidden(docs, carry if carry is not None else docs.columns)
    old = kept.where(F.col(key).isNotNull()).select(F.col(key).alias("__old"), kept["tree"].cast(TREE).alias("__tree")).dropDuplicates(["__old"])
    asked = docs.select(*cols, docs[f"`{text}`"].cast("string").alias("__text"), docs[f"`{key}`"].alias("__key")).join(old, F.col("__key") == F.col("__old"), "left").drop("__key", "__old")
    return _named(_counted(asked, tokenizer or vocabulary(), [i for i, _ in pairs], "text", keep), pairs, keep)


def _named(made: DataFrame, pairs: list[tuple[str, str]], keep: bool) -> DataFrame:
    results = {"n_tokens": "__n", "n_tokens_edited": "__after", "n_chars_edited": "__chars", "n_chars_encoded": "__encoded", **({"tree": "__tree"} if keep else {})}
    return made.select(*shown(pairs, *results), *[F.col(inner).alias(name) for name, inner in results.items()])
