"""Lines of the four feeds for tests: every value follows from a parcel number
and a day, so a test states only what it is about."""

import json


def line_a(n, status="IN_TRANSIT", day=3, clock="06:15:30", **other):
    line = {"tracking_no": f"ZX{n:04}", "status": status, "ts": f"2025-11-{day:02}T{clock}Z", "weight_kg": n + 0.5, "hub": f"HUB{n % 4}", "_ingested_at": f"2025-11-{day:02}T23:00:00Z"}
    return line | other


def line_b(n, code=20, day=3, clock="06:15:30", **other):
    line = {"barcode": f"QB{n:04}", "event": {"code": code, "desc": f"step {code}"}, "event_time": f"2025-11-{day:02} {clock}", "weight_g": 250 * n, "depot": f"DEP{n % 3}", "_ingested_at": "later"}
    return line | other


def line_c(n, state=1, millis=1_762_150_000_000, weight=2.25, **other):
    line = {"ref": f"RC{n:04}", "st": state, "t": millis + n, "dims": {"weight": weight}, "_ingested_at": "later"}
    return line | other


def line_p(n, kind="parcel_created", day=2, clock="17:40:00", carrier="carrier_a", tracking=None, **other):
    line = {
        "event_id": f"{kind}/{n}", "event_type": kind, "parcel_id": n, "tracking_number": tracking or f"ZX{n:04}", "organisation_id": 70 + n % 3,
        "carrier_code": carrier, "service_level": "evening", "destination_country": "BE", "destination_postcode": f"{9000 + n}",
        "recipient_email": f"reader{n}@mail.test", "occurred_at": f"2025-11-{day:02}T{clock}Z", "_ingested_at": "later",
    }
    return line | other


def torn(line, keep=0.4):
    """The beginning of a line, as after a broken upload."""
    text = json.dumps(line)
    return text[: int(len(text) * keep)]
