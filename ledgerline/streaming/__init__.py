"""The work is end-of-day batch, so there are no stateful stream operators here.

Row-wise operators and joins against a static dimension run unchanged on a streaming DataFrame.
"""

from ledgerline.functions.scalars import map_label, net_flow, threshold_label
from ledgerline.operators.filters import exclude, range_trim, require_not_null
from ledgerline.operators.joins import join_dim, map_codes, session_of
from ledgerline.plans.facts import camels_ratios, ohlcv_metrics
from ledgerline.sources.tables import coerce_types, conform, rename_aliases

STATELESS = (
    camels_ratios,
    coerce_types,
    conform,
    exclude,
    join_dim,
    map_codes,
    map_label,
    net_flow,
    ohlcv_metrics,
    range_trim,
    rename_aliases,
    require_not_null,
    session_of,
    threshold_label,
)
