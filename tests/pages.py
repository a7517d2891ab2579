"""Hand-written landing pages."""

from __future__ import annotations

import json
import os

from marketlake.contracts import EVENTS, MARKETS, SERIES, TAGS
from marketlake.queries.feed import landed_fields

CONDITION = "0x" + "a" * 64


def _filled(contract, carried=(), **values):
    """Every landed field of a contract but the optional ones, so that inference sees them."""
    names = landed_fields_by_column(contract)
    own = {f.name: None for f in landed_fields(contract, carried)}
    unknown = set(values) - set(own) - {"unknownField", "clobRewards", "eventMetadata"}
    assert not unknown, unknown
    for column in contract.optional:
        own.pop(names[column])
    for column in contract.columns:
        name = names[column.name]
        if name in own and column.kind == "boolean":
            own[name] = False
        elif name in own and column.kind in ("double", "bigint", "int"):
            own[name] = 1
    own.update({k: "" for k, v in own.items() if v is None})
    own.update(values)
    return own


def landed_fields_by_column(contract):
    key = contract.primary_key[0]
    special = {key: "id", key.replace("_id", "_slug"): "slug", "is_new": "new"}
    from marketlake.queries.feed import camel

    return {c: special.get(c, camel(c)) for c in contract.names}


def market(id, **values):
    base = dict(
        id=str(id),
        slug=f"market-{id}",
        question=f"Question {id}?",
        conditionId=CONDITION,
        startDate="2025-03-01T00:00:00Z",
        outcomes='["Yes", "No"]',
        outcomePrices='["0.4", "0.6"]',
        clobTokenIds=f'["{id}1", "{id}2"]',
        clobRewards=[{"id": "r"}],
        unknownField="x",
    )
    return _filled(MARKETS, ("event_id", "event_slug"), **{**base, **values})


def series(id, **values):
    base = dict(
        id=str(id), slug=f"series-{id}", ticker=f"S{id}", title=f"Series {id}",
        seriesType="single", subtitle="s", commentCount=0,
    )
    return _filled(SERIES, **{**base, **values})


def tag(id, **values):
    return _filled(TAGS, **{**dict(id=str(id), slug=f"tag-{id}", label=f"Tag {id}"), **values})


def event(id, markets=None, series=None, tags=None, **values):
    base = dict(
        id=str(id), slug=f"event-{id}", ticker=f"E{id}", title=f"Event {id}", active=True,
        closed=False, archived=False, startDate="2025-02-01", eventMetadata={"k": "v"},
    )
    doc = _filled(EVENTS, **{**base, **values})
    doc.update(markets=markets, series=series, tags=tags, eventCreators=[{"id": "c"}])
    return doc


def write(folder, name, docs):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        json.dump(docs, f, indent=2)


def list_page(landing, active, closed, number, docs):
    feed = f"{'active' if active else 'inactive'}_{'closed' if closed else 'open'}"
    write(os.path.join(landing, "list"), f"events_{feed}_page_{number}.json", docs)


def by_id_page(landing, ids, docs):
    name = "events_" + ",".join(str(i) for i in sorted(ids)) + ".json"
    write(os.path.join(landing, "by_id"), name, docs)
