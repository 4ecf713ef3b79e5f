"""Result envelopes: JSON, TSV and XML."""

from __future__ import annotations

import json
from xml.sax.saxutils import escape

from lexivane.operators.distance import OOV_MESSAGE, Result

TYPES = {"_key": "ShortText", "_value": "Float", "_score": "Int32", "_id": "UInt32"}


def table_of(result: Result) -> tuple[int, list[list[str]], list[list]]:
    """Hit count, columns with their types, and the page's rows; an unknown word gives one row that says so."""
    columns = [["_pca_value" if c.startswith("_pca_value_") else c, "Float" if c.startswith("_pca_value_") else TYPES.get(c, "ShortText")] for c in result.columns]
    if result.oov:
        return 0, columns[:2], [[OOV_MESSAGE, 0.0]]
    lead = []
    if result.lead:
        own = result.hits.filter("word_id < 0").select(*result.columns).collect()
        rest = result.hits.filter("word_id >= 0").orderBy(*result.order).offset(result.offset)
        rest = rest.limit(result.limit) if result.limit >= 0 else rest
        lead = [list(r) for r in own]
        rows = lead + [list(r) for r in rest.select(*result.columns).collect()]
    else:
        rows = [list(r) for r in result.rows().collect()]
    return result.nhits(), columns, rows


def to_json(result: Result) -> str:
    if result.expanded is not None:
        return json.dumps(result.expanded, ensure_ascii=False)
    n, columns, rows = table_of(result)
    return json.dumps([[[n], columns, *rows]], ensure_ascii=False, default=str)


def to_tsv(result: Result) -> str:
    if result.expanded is not None:
        return result.expanded
    n, columns, rows = table_of(result)
    return "\n".join(["\t".join(map(str, r)) for r in ([n], [c for c, _ in columns], *rows)])


def to_xml(result: Result) -> str:
    if result.expanded is not None:
        return f"<TEXT>{escape(result.expanded)}</TEXT>"
    n, columns, rows = table_of(result)
    hits = "".join("<HIT NO=\"%d\">%s</HIT>" % (i + 1, "".join(f'<FIELD NAME="{escape(c)}">{escape(str(v))}</FIELD>' for (c, _), v in zip(columns, r))) for i, r in enumerate(rows))
    return f'<RESULT><RESULTSET NHITS="{n}">{hits}</RESULTSET></RESULT>'
