"""All queries of the analytics engine and their SQL twins."""

from __future__ import annotations

from trailmark.plans import composed, lookups, offers, people, records, streams, traffic

QUERIES = {**traffic.Q, **people.Q, **offers.Q, **lookups.Q, **streams.Q, **records.Q, **composed.Q}
ORACLE = {**traffic.SQL, **people.SQL, **offers.SQL, **lookups.SQL, **streams.SQL, **records.SQL, **composed.SQL}
