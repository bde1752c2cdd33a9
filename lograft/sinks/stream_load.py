"""K4 transport half: hand each envelope to an injected ``send(label, body)``.

The data half (chunking rows into ``{"data":[...]}`` bodies with stable
labels) is ``lograft.operators.envelope``.  Sending happens in the tasks
(``foreachPartition``), never on the driver; a failed send raises so the
task is retried, and the label lets the receiver drop a repeated body.
"""

from __future__ import annotations

import base64
import json
import urllib.request
from collections.abc import Callable

from pyspark.sql import DataFrame

Sender = Callable[[str, str], None]


def send_envelopes(envelopes: DataFrame, senders: Sender | list[Sender]) -> None:
    """Send every envelope; with a list, by its ``shard``."""
    def _part(rows):
        for r in rows:
            send = senders[r["shard"]] if isinstance(senders, list) else senders
            send(r["label"], r["body"])
    columns = ["label", "body", "shard"] if isinstance(senders, list) else ["label", "body"]
    envelopes.select(*columns).foreachPartition(_part)


#: Load statuses that mean the rows are in the table.  Fixed values.
APPLIED = ("Success", "Publish Timeout", "Label Already Exists")


def check_response(status: int, body: str) -> None:
    """Raise unless the load was applied; the protocol reports failures inside a 200 answer."""
    if status // 100 != 2:
        raise IOError(f"stream load failed: {status}")
    answer = json.loads(body or "{}")
    if answer.get("Status") not in APPLIED:
        raise IOError(f"stream load rejected: {answer.get('Status')}: {answer.get('Message')}")


def http_put_sender(url: str, user: str, password: str, timeout: float = 60.0) -> Sender:
    """Minimal PUT sender: JSON body, basic auth, label header; raises on non-2xx.

    No node failover or redirect rewriting (see README, "Not built")."""
    token = base64.b64encode(f"{user}:{password}".encode()).decode()

    def send(label: str, body: str) -> None:
        req = urllib.request.Request(url, data=body.encode("utf-8"), method="PUT")
        req.add_header("Authorization", f"Basic {token}")
        req.add_header("Expect", "100-continue")
        # Stream-load headers for a {"data":[...]} JSON body.
        req.add_header("label", label)
        req.add_header("Content-Type", "application/json")
        req.add_header("format", "json")
        req.add_header("strip_outer_array", "true")
        req.add_header("json_root", "$.data")
        with urllib.request.urlopen(req, timeout=timeout) as resp:  # noqa: S310
            check_response(resp.status, resp.read().decode("utf-8"))
    return send
