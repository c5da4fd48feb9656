"""The registered queries restated as SQL over the star-schema tables.

Everything is computed from the source columns by integer arithmetic, never
through hex or the operators' own code, so that the two sides are independent.
"""

from __future__ import annotations

from spanledger import constants as C
from spanledger.model_rules import LAYERS, MODEL_RULES
from spanledger.plans.star_input import CHAINS, EPOCH, TOKENS, WINDOW

IDS = "[" + ",".join(f"{i}::BIGINT" for _, i in CHAINS) + "]"
NAMES = "[" + ",".join(f"'{n}'" for n, _ in CHAINS) + "]"
SYMBOLS = "[" + ",".join(f"'{s}'" if s else "NULL" for s, _, _ in TOKENS) + "]"
DECIMALS = "[" + ",".join(str(d) for _, d, _ in TOKENS) + "]"
SUPPORTED = "(" + ",".join(str(i) for i in C.SUPPORTED_CHAIN_IDS) + ")"
SUPPORTED_NAMES = "(" + ",".join(f"'{n}'" for n in C.SUPPORTED_CHAINS) + ")"
LISTED = C.EXCLUDED_DEPOSIT_TOKENS[0]


def rnd(x: str, n: int) -> str:
    """Rounding of the 15 significant digits, half away from zero."""
    return f"CAST(round(CAST(printf('%.14e', ({x})::DOUBLE) AS DECIMAL(38,20)), {n}) AS DOUBLE)"


def money_sum(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(28,2))) AS DOUBLE)"


def ts(epoch: str) -> str:
    return f"make_timestamp(({epoch}) * 1000000)"


def addr(n: str) -> str:
    return f"printf('0x%040x', {n})"


def token(chain: str) -> str:
    return f"CASE WHEN slot = 6 AND {chain} = 137 THEN '{LISTED}' ELSE printf('0x%040x', {chain} * 16 + slot + 1) END"


def case(x: str, bounds: list, rest: str) -> str:
    whens = " ".join(f"WHEN {x} > {b} THEN '{label}'" for b, label in bounds)
    return f"CASE {whens} ELSE '{rest}' END"


def file_of(chain: str) -> str:
    return f"concat('logs_', {chain}, '_{WINDOW[0]}_to_{WINDOW[1]}_processed.parquet')"


def keys(k: str) -> str:
    return f"""{k} AS k, {k} % 16 AS oi, ({k} % 16 + 1 + ({k} // 16) % 15) % 16 AS di, ({k} * 3) % 16 AS ri,
        ({k} // 7) % 7 AS slot, {EPOCH} + ({k} * 2617) % 2592000 AS dep"""


CTES = {
    "o0": f"SELECT {keys('o_orderkey')}, o_custkey AS cust, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, "
    "o_orderpriority = '1-URGENT' AS native FROM orders",
    "o": f"""SELECT *, cents * 999 // 1000 AS exp_cents, {IDS}[oi + 1] AS oid, {IDS}[di + 1] AS did, {NAMES}[oi + 1] AS oname,
        {NAMES}[di + 1] AS dname, {SYMBOLS}[slot + 1] AS sym, {DECIMALS}[slot + 1] AS dec,
        printf('0xd%063x', k) AS dhash FROM o0""",
    "f0": """SELECT o.*, l_partkey AS pk, l_suppkey AS sk, l_linenumber AS ln, l_returnflag AS rf,
        CAST(round(l_discount * 100) AS BIGINT) AS d, round(l_tax * 100) <> 8 AS gas,
        (l_partkey * 7 + l_suppkey * 13 + l_linenumber * 101) % 1000 AS m
        FROM lineitem JOIN o ON l_orderkey = k WHERE l_linestatus = 'F'""",
    "f": f"""SELECT *, dep + m * m * m * m // 1000000000 - 5 AS fep,
        CASE WHEN d = 0 THEN cents + cents // 1000 ELSE cents - cents * d // 1000 END AS out_cents,
        {IDS}[ri + 1] AS rid,
        CASE WHEN gas THEN (pk % 1000 + 1) * (pk % 1000 + 1) * (pk % 1000 + 1) * 1000 END AS gp,
        CASE WHEN gas THEN sk * 37 + 60000 END AS gu,
        concat('0xf', printf('%021x', k), printf('%014x', pk), printf('%014x', sk), printf('%014x', ln)) AS fhash FROM f0""",
    "rl": f"""SELECT {keys('l_orderkey')}, l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk,
        CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem WHERE l_linestatus = 'O'""",
    "rl2": f"""SELECT *, {DECIMALS}[slot + 1] AS dec, cents::HUGEINT * CAST(pow(10, {DECIMALS}[slot + 1] - 2) AS HUGEINT) AS raw,
        row_number() OVER (PARTITION BY k ORDER BY ln, pk, sk, cents) AS pos FROM rl""",
    "r": f"""SELECT k, any_value(oi) AS oi, any_value(ri) AS ri, any_value(slot) AS slot, any_value(dep) AS dep, any_value(dec) AS dec,
        sum(cents)::BIGINT AS cents, count(*)::BIGINT AS n, string_agg(raw::VARCHAR, ',' ORDER BY pos) AS amounts,
        string_agg({addr('sk')}, ',' ORDER BY pos) AS addresses, {IDS}[any_value(ri) + 1] AS rid,
        {NAMES}[any_value(ri) + 1] AS rname, {SYMBOLS}[any_value(slot) + 1] AS sym, printf('0xe%063x', k) AS rhash
        FROM rl2 GROUP BY k""",
    "pr": "SELECT "
    + "CASE event_type "
    + " ".join(f"WHEN '{e}' THEN '{s}'" for s, _, e in TOKENS if e)
    + " END AS sym, ts, value FROM events",
    "hp": "SELECT sym, date_trunc('hour', ts) AS h, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100 / count(*) AS price "
    "FROM pr GROUP BY ALL",
    "landed": f"""
        SELECT 'd' AS ev, dhash AS tx, {ts('dep')} AS t, oname AS chain, 30000000000 AS gp, cust + 50000 AS gu, k, 1 AS ln FROM o
        UNION ALL SELECT 'f', fhash, {ts('fep')}, dname, gp, gu, k, ln FROM f
        UNION ALL SELECT 'r', rhash, {ts('dep + 86400')}, rname, 1000000000, 90000, k, 1 FROM r""",
    "stage_deposits": f"""SELECT {ts('dep')} AS deposit_timestamp, dhash AS transaction_hash, oname AS blockchain,
        {file_of('oname')} AS source_file, did AS destination_chain_id, k AS deposit_id, {addr('cust')} AS depositor_address,
        {token('oid')} AS input_token_address, sym AS input_token_symbol,
        CASE WHEN native THEN '{C.ZERO_ADDRESS}' ELSE {token('did')} END AS output_token_address,
        CASE WHEN NOT native THEN sym END AS output_token_symbol,
        cents::DOUBLE * pow(10, dec - 2) / pow(10, dec) AS input_amount,
        exp_cents::DOUBLE * pow(10, dec - 2) / pow(10, dec) AS output_amount,
        cents::DOUBLE * pow(10, dec - 2) AS input_amount_raw, exp_cents::DOUBLE * pow(10, dec - 2) AS output_amount_raw,
        {addr('cust + 1')} AS recipient_address FROM o""",
    "stage_fills": f"""SELECT {ts('fep')} AS fill_timestamp, fhash AS transaction_hash, dname AS blockchain,
        {file_of('dname')} AS source_file, oid AS origin_chain_id, k AS deposit_id, {addr('sk')} AS relayer_address,
        {token('oid')} AS input_token_address, sym AS input_token_symbol, {token('did')} AS output_token_address,
        sym AS output_token_symbol, cents::DOUBLE * pow(10, dec - 2) / pow(10, dec) AS input_amount,
        out_cents::DOUBLE * pow(10, dec - 2) / pow(10, dec) AS output_amount,
        cents::DOUBLE * pow(10, dec - 2) AS input_amount_raw, out_cents::DOUBLE * pow(10, dec - 2) AS output_amount_raw,
        rid AS repayment_chain_id, '{C.ZERO_ADDRESS}' AS exclusive_relayer_address, {addr('cust')} AS depositor_address,
        {addr('cust + 1')} AS recipient_address, gp AS gas_price_wei, gu AS gas_used, CAST(gp * gu AS DOUBLE) AS gas_cost_wei,
        did AS destination_chain_id FROM f""",
    "stage_refunds": f"""SELECT {ts('dep + 86400')} AS refund_timestamp, rhash AS transaction_hash, rname AS blockchain,
        {file_of('rname')} AS source_file, rid AS chain_id, k // 5 AS root_bundle_id, k % 5 AS leaf_id,
        {token('rid')} AS refund_token_address, cents::DOUBLE * pow(10, dec - 2) AS total_refund_amount,
        amounts AS refund_amounts_string, addresses AS refund_addresses_string, n AS refund_count FROM r""",
    "unified_deposits": f"""SELECT s.deposit_timestamp, s.transaction_hash, o.oid AS origin_chain_id, o.oname AS origin_chain_name,
        s.destination_chain_id, o.dname AS destination_chain_name, s.deposit_id, s.depositor_address, s.recipient_address,
        s.input_token_address, s.input_token_symbol, s.output_token_address, s.output_token_symbol, s.input_amount, s.output_amount,
        hp.price AS input_token_price_usd, {rnd('s.input_amount * coalesce(hp.price, 1)', 2)} AS input_amount_usd
        FROM stage_deposits s JOIN o ON s.deposit_id = o.k
        LEFT JOIN hp ON s.input_token_symbol = hp.sym AND date_trunc('hour', s.deposit_timestamp) = hp.h
        WHERE o.oid IN {SUPPORTED} AND o.did IN {SUPPORTED}""",
    "unified_fills": f"""SELECT s.fill_timestamp, s.transaction_hash, s.origin_chain_id,
        {NAMES}[list_position({IDS}, s.origin_chain_id)] AS origin_chain_name, s.destination_chain_id,
        s.blockchain AS destination_chain_name, s.deposit_id, s.relayer_address, s.depositor_address, s.recipient_address,
        s.input_token_address, s.output_token_address, s.output_token_symbol AS fill_token_symbol, s.input_amount, s.output_amount,
        s.repayment_chain_id, s.gas_price_wei, s.gas_used, s.gas_cost_wei, hp.price AS output_token_price_usd,
        {rnd('s.output_amount * coalesce(hp.price, 1)', 2)} AS output_amount_usd FROM stage_fills s
        LEFT JOIN hp ON s.output_token_symbol = hp.sym AND date_trunc('hour', s.fill_timestamp) = hp.h
        WHERE s.origin_chain_id IN {SUPPORTED} AND s.destination_chain_id IN {SUPPORTED}""",
    "unified_refunds": f"""SELECT s.refund_timestamp, s.transaction_hash, s.chain_id, s.blockchain AS chain_name, s.root_bundle_id, s.leaf_id,
        s.refund_token_address, r.sym AS refund_token_symbol, CASE WHEN r.sym IS NOT NULL THEN r.dec::BIGINT END AS token_decimals,
        s.total_refund_amount / pow(10, r.dec) AS total_refund_amount, s.total_refund_amount AS total_refund_amount_raw,
        s.refund_addresses_string, s.refund_amounts_string, s.refund_count, s.blockchain AS source_blockchain
        FROM stage_refunds s JOIN r ON s.transaction_hash = r.rhash WHERE s.chain_id IN {SUPPORTED}""",
    "refunds_expanded": f"""SELECT u.refund_timestamp, u.transaction_hash, u.source_blockchain, u.chain_id, u.chain_name, u.root_bundle_id,
        u.leaf_id, rl2.pos AS refund_index, {addr('rl2.sk')} AS relayer_address, u.refund_token_address, u.refund_token_symbol,
        rl2.cents::DOUBLE * pow(10, rl2.dec - 2) / pow(10, rl2.dec) AS refund_amount,
        rl2.cents::DOUBLE * pow(10, rl2.dec - 2) AS refund_amount_raw, hp.price AS refund_token_price_usd,
        {rnd('rl2.cents::DOUBLE * pow(10, rl2.dec - 2) / pow(10, rl2.dec) * coalesce(hp.price, 1)', 2)} AS refund_amount_usd,
        u.total_refund_amount AS batch_total_amount, u.total_refund_amount_raw AS batch_total_amount_raw,
        u.refund_count AS batch_refund_count, concat(u.transaction_hash, '-', u.leaf_id, '-', rl2.pos) AS refund_id
        FROM unified_refunds u JOIN rl2 ON u.root_bundle_id * 5 + u.leaf_id = rl2.k
        LEFT JOIN hp ON u.refund_token_symbol = hp.sym AND date_trunc('hour', u.refund_timestamp) = hp.h""",
    "nt": "SELECT unnest([" + ",".join(f"{k}::BIGINT" for k in C.NATIVE_TOKENS) + "]) AS chain_id, unnest(["
    + ",".join(f"'{v}'" for v in C.NATIVE_TOKENS.values()) + "]) AS native",
    "m0": """SELECT d.deposit_timestamp, d.transaction_hash AS deposit_tx_hash, d.origin_chain_id, d.origin_chain_name,
        d.destination_chain_id, d.destination_chain_name, d.deposit_id, d.depositor_address, d.recipient_address AS deposit_recipient,
        d.input_token_address AS deposit_token, d.input_token_symbol AS deposit_token_symbol, d.input_amount AS deposit_amount,
        d.output_amount AS expected_output_amount, d.input_token_price_usd AS deposit_token_price_usd,
        f.fill_timestamp, f.transaction_hash AS fill_tx_hash, f.relayer_address, f.output_token_address AS fill_token, f.fill_token_symbol,
        f.output_amount AS actual_output_amount, f.repayment_chain_id, f.output_token_price_usd AS fill_token_price_usd,
        f.deposit_id IS NOT NULL AS is_filled, f.gas_price_wei, f.gas_used, f.gas_cost_wei, np.price AS native_price
        FROM unified_deposits d LEFT JOIN unified_fills f ON d.deposit_id = f.deposit_id AND d.origin_chain_id = f.origin_chain_id
          AND d.destination_chain_id = f.destination_chain_id
        LEFT JOIN nt ON d.destination_chain_id = nt.chain_id
        LEFT JOIN hp np ON nt.native = np.sym AND date_trunc('hour', f.fill_timestamp) = np.h
        WHERE d.input_token_address NOT IN (""" + ",".join(f"'{t}'" for t in C.EXCLUDED_DEPOSIT_TOKENS) + ")",
    "m1": f"""SELECT *, CASE WHEN is_filled THEN greatest(0, date_diff('second', deposit_timestamp, fill_timestamp))::DOUBLE END AS fill_latency_seconds,
        {rnd('deposit_amount - actual_output_amount', 2)} AS bridge_fee_nominal,
        {rnd('(deposit_amount - actual_output_amount) / nullif(deposit_amount, 0) * 100', 2)} AS bridge_fee_percent,
        CASE WHEN expected_output_amount > 0
          THEN {rnd('(expected_output_amount - actual_output_amount) / expected_output_amount * 100', 2)} END AS slippage_percent FROM m0""",
    "deposit_fill_matching": f"""SELECT deposit_timestamp, deposit_tx_hash, origin_chain_id, origin_chain_name, destination_chain_id,
        destination_chain_name, deposit_id, depositor_address, deposit_recipient, deposit_token, deposit_token_symbol, deposit_amount,
        expected_output_amount, deposit_token_price_usd,
        {rnd('deposit_amount * coalesce(deposit_token_price_usd, 1)', 2)} AS deposit_amount_usd,
        fill_timestamp, fill_tx_hash, relayer_address, fill_token, fill_token_symbol, actual_output_amount, repayment_chain_id,
        fill_token_price_usd, {rnd('actual_output_amount * coalesce(fill_token_price_usd, 1)', 2)} AS fill_amount_usd,
        fill_latency_seconds, is_filled, bridge_fee_nominal, bridge_fee_percent, slippage_percent, gas_price_wei, gas_used, gas_cost_wei,
        {rnd('gas_cost_wei / 1e18', 8)} AS gas_cost_native,
        {rnd('gas_cost_wei / 1e18 * coalesce(native_price, 0)', 2)} AS gas_cost_usd,
        {rnd('bridge_fee_nominal * coalesce(deposit_token_price_usd, 1)', 2)} AS bridge_fee_nominal_usd,
        origin_chain_name || ' → ' || destination_chain_name AS route_name, origin_chain_id || '_' || destination_chain_id AS route_id,
        CASE WHEN is_filled THEN {case('fill_latency_seconds', C.LATENCY_TIERS, C.LATENCY_REST)} END AS latency_tier FROM m1""",
    "mm": "SELECT *, date_trunc('minute', deposit_timestamp) AS deposit_minute FROM deposit_fill_matching",
}

# Names of the labels a mart row gets from its route and token.
_LABELS = """any_value(origin_chain_name) AS origin_chain_name, any_value(destination_chain_name) AS destination_chain_name,
    any_value(route_name) AS route_name, any_value(deposit_token_symbol) AS token_symbol,
    any_value(CASE WHEN deposit_token_symbol = 'USDC.e' THEN 'USDC' ELSE deposit_token_symbol END) AS base_token_symbol"""
_GRAIN = "deposit_minute, origin_chain_id, destination_chain_id, route_id, deposit_token"
_FILL_RATE = rnd("count(*) FILTER (WHERE is_filled)::DOUBLE / count(*) * 100", 2)

CTES["general_overview"] = f"""SELECT {_GRAIN}, {_LABELS}, count(*)::BIGINT AS total_deposits,
    (count(*) FILTER (WHERE is_filled))::BIGINT AS total_fills, {rnd('sum(deposit_amount)', 2)} AS total_deposit_volume,
    {rnd('sum(CASE WHEN is_filled THEN actual_output_amount ELSE 0 END)', 2)} AS total_filled_volume,
    {money_sum('deposit_amount_usd')} AS total_deposit_volume_usd,
    {money_sum('CASE WHEN is_filled THEN fill_amount_usd ELSE 0 END')} AS total_filled_volume_usd,
    count(DISTINCT depositor_address)::BIGINT AS unique_depositors,
    (count(DISTINCT relayer_address) FILTER (WHERE is_filled))::BIGINT AS unique_relayers, {_FILL_RATE} AS fill_rate_pct,
    {rnd('avg(fill_latency_seconds)', 2)} AS avg_fill_latency_seconds,
    {rnd('quantile_cont(fill_latency_seconds, 0.5)', 2)} AS median_fill_latency_seconds,
    {money_sum('CASE WHEN is_filled THEN bridge_fee_nominal ELSE 0 END')} AS total_bridge_fees,
    {rnd('avg(bridge_fee_percent)', 4)} AS avg_bridge_fee_pct, {rnd('avg(slippage_percent)', 4)} AS avg_slippage_pct
    FROM mm GROUP BY {_GRAIN}"""

CTES["lat"] = f"""SELECT {_GRAIN}, {_LABELS}, count(*)::BIGINT AS total_deposits,
    (count(*) FILTER (WHERE is_filled))::BIGINT AS total_fills, (count(*) FILTER (WHERE NOT is_filled))::BIGINT AS unfilled_count,
    {_FILL_RATE} AS fill_rate_pct, {money_sum('deposit_amount_usd')} AS total_deposit_volume_usd,
    {money_sum('CASE WHEN is_filled THEN fill_amount_usd ELSE 0 END')} AS total_filled_volume_usd,
    {rnd('avg(fill_latency_seconds)', 2)} AS avg_ttf_seconds, {rnd('quantile_cont(fill_latency_seconds, 0.5)', 2)} AS median_ttf_seconds,
    {rnd('quantile_cont(fill_latency_seconds, 0.95)', 2)} AS p95_ttf_seconds, min(fill_latency_seconds) AS min_ttf_seconds,
    max(fill_latency_seconds) AS max_ttf_seconds, (count(*) FILTER (WHERE fill_latency_seconds <= 30))::BIGINT AS instant_fill_count,
    (count(*) FILTER (WHERE fill_latency_seconds <= 60))::BIGINT AS fast_fill_count,
    (count(*) FILTER (WHERE fill_latency_seconds > 300))::BIGINT AS slow_fill_count,
    (count(*) FILTER (WHERE fill_latency_seconds > 900))::BIGINT AS very_slow_fill_count,
    count(DISTINCT relayer_address)::BIGINT AS unique_relayers FROM mm GROUP BY {_GRAIN}"""
CTES["fill_latency_analysis"] = (
    "SELECT *, "
    + ", ".join(
        f"{rnd(f'{b}_fill_count::DOUBLE / nullif(total_fills, 0) * 100', 2)} AS {b}_fill_pct"
        for b in ("instant", "fast", "slow", "very_slow")
    )
    + f", {case('p95_ttf_seconds', C.LIQUIDITY_GAP_TIERS, C.LIQUIDITY_GAP_REST)} AS liquidity_gap_status FROM lat"
)

_FEE_USD = "bridge_fee_nominal * coalesce(deposit_token_price_usd, 1)"
CTES["fee"] = f"""SELECT {_GRAIN}, {_LABELS}, count(*)::BIGINT AS total_fills, {money_sum('deposit_amount_usd')} AS total_deposit_volume_usd,
    {money_sum('fill_amount_usd')} AS total_filled_volume_usd, {rnd(f'sum({_FEE_USD})', 2)} AS total_fees_usd,
    {rnd(f"sum({_FEE_USD}) / nullif({money_sum('deposit_amount_usd')}, 0) * 100", 4)} AS effective_fee_pct,
    {rnd('avg(bridge_fee_percent)', 4)} AS avg_fee_pct, {rnd('quantile_cont(bridge_fee_percent, 0.5)', 4)} AS median_fee_pct,
    {rnd('stddev_samp(bridge_fee_percent)', 4)} AS fee_std_dev, {rnd('min(bridge_fee_percent)', 4)} AS min_fee_pct,
    {rnd('max(bridge_fee_percent)', 4)} AS max_fee_pct, {rnd('avg(slippage_percent)', 4)} AS avg_slippage_pct,
    {rnd('quantile_cont(slippage_percent, 0.5)', 4)} AS median_slippage_pct, count(DISTINCT depositor_address)::BIGINT AS unique_depositors,
    count(DISTINCT relayer_address)::BIGINT AS unique_relayers, {rnd('avg(gas_price_wei) / 1e9', 4)} AS avg_gas_price_gwei,
    {rnd('quantile_cont(gas_price_wei::DOUBLE, 0.5) / 1e9', 4)} AS median_gas_price_gwei,
    {rnd('sum(gas_cost_wei) / 1e18', 8)} AS total_gas_cost_native,
    {rnd('sum(gas_cost_wei) / count(gas_cost_wei) / 1e18', 8)} AS avg_gas_cost_native,
    {money_sum('gas_cost_usd')} AS total_gas_cost_usd,
    {rnd(money_sum('gas_cost_usd') + ' / nullif(count(gas_cost_usd), 0)', 4)} AS avg_gas_cost_usd FROM mm WHERE is_filled GROUP BY {_GRAIN}"""
CTES["bridge_fee_analysis"] = f"""SELECT *, {rnd('max_fee_pct - min_fee_pct', 4)} AS fee_spread_pct,
    {case('effective_fee_pct', C.PRICING_TIERS, C.PRICING_REST)} AS pricing_tier,
    {case('fee_std_dev', C.VOLATILITY_TIERS, C.VOLATILITY_REST)} AS fee_volatility_tier,
    {case('avg_gas_cost_native', C.GAS_TIERS, C.GAS_REST)} AS gas_cost_tier FROM fee"""
CTES["rv"] = f"""SELECT origin_chain_name, destination_chain_name, route_name, relayer_address, {money_sum('fill_amount_usd')} AS v
    FROM deposit_fill_matching WHERE is_filled AND route_name IS NOT NULL AND fill_amount_usd > 0 GROUP BY ALL"""
CTES["rk"] = """SELECT *, row_number() OVER (PARTITION BY route_name ORDER BY v DESC, relayer_address) AS rn,
    sum(CAST(v AS DECIMAL(28,2))) OVER (PARTITION BY route_name) AS tot FROM rv"""
CTES["cr"] = f"""SELECT origin_chain_name, destination_chain_name, route_name, CAST(any_value(tot) AS DOUBLE) AS total,
    {money_sum('v')} AS top3 FROM rk WHERE rn <= 3 GROUP BY ALL"""

# Which CTEs each CTE reads.
_ORDER = list(CTES)


def _needed(sql: str) -> list[str]:
    """CTE names a statement uses, directly or through others, in order."""
    import re

    found: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", todo.pop()))
        for name in words & set(CTES) - found:
            found.add(name)
            todo.append(CTES[name])
    return [n for n in _ORDER if n in found]


def over(sql: str) -> str:
    names = _needed(sql)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in names) + "\n" + sql if names else sql


def _model(name: str) -> str:
    return f"SELECT * FROM {name}"


def _rules(pairs: dict[str, str], source: str) -> str:
    """A rule report: one row per rule with its violations."""
    return "\nUNION ALL ".join(
        f"SELECT '{rule}' AS rule, (count(*) FILTER (WHERE {cond}))::BIGINT AS failures, count(*)::BIGINT AS checked, "
        f"count(*) FILTER (WHERE {cond}) = 0 AS passed FROM {source}"
        for rule, cond in pairs.items()
    )


def _sql_list(values: list) -> str:
    return "(" + ",".join(str(v).upper() if isinstance(v, bool) else f"'{v}'" if isinstance(v, str) else str(v) for v in values) + ")"


def model_rules(models: list[str]) -> str:
    parts = []
    for model in models:
        declared = MODEL_RULES[model]
        rules = {f"not_null {c}": f"{c} IS NULL" for c in declared["not_null"]}
        rules |= {f"accepted_values {c}": f"{c} NOT IN {_sql_list(v)}" for c, v in declared.get("accepted", {}).items()}
        parts += [
            f"SELECT '{model}' AS model, '{r}' AS rule, 'error' AS severity, (count(*) FILTER (WHERE {c}))::BIGINT AS failures, "
            f"count(*)::BIGINT AS checked, count(*) FILTER (WHERE {c}) = 0 AND count(*) > 0 AS passed FROM {model}"
            for r, c in rules.items()
        ]
        for unique in declared.get("unique", []):
            cols = ", ".join(unique)
            parts.append(
                f"SELECT '{model}' AS model, 'unique {cols}' AS rule, 'error' AS severity, (count(*) FILTER (WHERE n > 1))::BIGINT AS failures, "
                f"coalesce(sum(n), 0)::BIGINT AS checked, count(*) FILTER (WHERE n > 1) = 0 AND count(*) > 0 AS passed "
                f"FROM (SELECT {cols}, count(*) AS n FROM {model} GROUP BY {cols})"
            )
    return "\nUNION ALL ".join(parts)


def _chain_rules(layer: str, model: str, source: str, chain: str, columns: dict[str, str]) -> list[str]:
    """The rules of a model for each chain; ``columns`` renames where the source has other names."""
    declared = MODEL_RULES[model]
    rules = {f"not_null {c}": f"{columns.get(c, c)} IS NULL" for c in declared["not_null"]}
    rules |= {f"accepted_values {c}": f"{c} NOT IN {_sql_list(v)}" for c, v in declared.get("accepted", {}).items()}
    head = f"SELECT '{layer}' AS layer, '{model}' AS model, {chain} AS chain, "
    parts = []
    for r, c in rules.items():
        only = "('arbitrum')" if r == "not_null topic_0" else SUPPORTED_NAMES
        parts.append(
            f"{head}'{r}' AS rule, 'error' AS severity, (count(*) FILTER (WHERE {c}))::BIGINT AS failures, count(*)::BIGINT AS checked, "
            f"count(*) FILTER (WHERE {c}) = 0 AS passed FROM {source} WHERE {chain} IN {only} GROUP BY {chain}"
        )
    for unique in declared.get("unique", []):
        cols = ", ".join(unique)
        parts.append(
            f"{head}'unique {cols}' AS rule, 'error' AS severity, (count(*) FILTER (WHERE n > 1))::BIGINT AS failures, sum(n)::BIGINT AS checked, "
            f"count(*) FILTER (WHERE n > 1) = 0 AS passed FROM (SELECT {cols}, count(*) AS n FROM {source} GROUP BY {cols}) "
            f"WHERE {chain} IN {SUPPORTED_NAMES} GROUP BY {chain}"
        )
    return parts


def declared_checks() -> str:
    """A verdict for every declared check, for each chain of the source and staging layers."""
    renamed = {"transactionHash": "tx", "timestamp_datetime": "t", "topic_0": "ev"}
    parts = _chain_rules("source", "landed_logs", "landed", "chain", renamed)
    for model in LAYERS["staging"]:
        parts += _chain_rules("staging", model, model, "blockchain", {})
    for layer in ("intermediate", "marts"):
        parts.append(f"SELECT '{layer}' AS layer, model, NULL AS chain, rule, severity, failures, checked, passed FROM ({model_rules(LAYERS[layer])})")
    return "\nUNION ALL ".join(parts)
