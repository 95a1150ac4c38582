"""Hand-written documents and rows."""

from __future__ import annotations

import datetime as dt

UTC = dt.timezone.utc


def utc(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def point(position=None, value=None, field="quantity") -> str:
    parts = [("position", position), (field, value)]
    return "<Point>" + "".join(f"<{n}>{v}</{n}>" for n, v in parts if v is not None) + "</Point>"


def period(points, start="2026-09-19T22:00Z", resolution="PT15M") -> str:
    begin = "" if start is None else f"<timeInterval><start>{start}</start><end>x</end></timeInterval>"
    step = "" if resolution is None else f"<resolution>{resolution}</resolution>"
    return f"<Period>{begin}{step}{''.join(points)}</Period>"


def generation_series(periods, zone="Z", code="B16") -> str:
    head = "" if zone is None else (
        f'<inBiddingZone_Domain.mRID codingScheme="A01">{zone}</inBiddingZone_Domain.mRID>'
    )
    kind = "" if code is None else f"<MktPSRType><psrType>{code}</psrType></MktPSRType>"
    unit = "<quantity_Measure_Unit.name>MAW</quantity_Measure_Unit.name>"
    return f"<TimeSeries><mRID>1</mRID>{head}{kind}{unit}{''.join(periods)}</TimeSeries>"


def price_series(periods, zone="Z") -> str:
    return (
        f"<TimeSeries><in_Domain.mRID>{zone}</in_Domain.mRID>"
        "<currency_Unit.name>EUR</currency_Unit.name>"
        f"<price_Measure_Unit.name>MWH</price_Measure_Unit.name>{''.join(periods)}</TimeSeries>"
    )


def document(*series: str, head: str = "", namespace: str = ' xmlns="urn:a:b:1"') -> str:
    return f'<?xml version="1.0" encoding="UTF-8"?>\n<Doc{namespace}>{head}{"".join(series)}</Doc>'


def generation_document(points, **options) -> str:
    series = {k: options.pop(k) for k in ("zone", "code") if k in options}
    return document(generation_series([period(points, **options)], **series))


def price_document(values, revision="1", created="2026-09-19T11:00:00Z", **options) -> str:
    head = "" if revision is None else f"<revisionNumber>{revision}</revisionNumber>"
    head += "" if created is None else f"<createdDateTime>{created}</createdDateTime>"
    points = [point(p, v, "price.amount") for p, v in values]
    zone = options.pop("zone", "Z")
    return document(price_series([period(points, **options)], zone), head=head)


def docs_frame(spark, *texts: str):
    return spark.createDataFrame([(t,) for t in texts], "document string")
