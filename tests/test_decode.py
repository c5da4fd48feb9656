"""Event decoding: event dispatch, truncated data, dynamic arrays."""

from pyspark.sql import functions as F

from spanledger import constants as C
from spanledger.operators.decode import decode_logs, undecodable_logs
from spanledger.schemas import DECODED
from spanledger.sources.chains import supported_chains

SCHEMA = "topics ARRAY<STRING>, data STRING, timeStamp STRING, gasPrice STRING, gasUsed STRING, transactionHash STRING, blockchain STRING"


def w(n):
    return f"{n:064x}"


def decode_all(spark, pairs):
    rows = [(t, d, "0x659200ff", "0x3b9aca00", None, f"0x{i:04x}", "base") for i, (t, d) in enumerate(pairs)]
    return sorted(decode_logs(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda r: r.transactionHash)


def decode(spark, topics, data):
    return decode_all(spark, [(topics, data)])[0]


def refund_data(amounts, addresses, total=5, token=9, flag=0, caller=3, first=192, second=None):
    second = 192 + 32 * (1 + len(amounts)) if second is None else second
    head = [w(total), w(first), w(token), w(second), w(flag), w(caller)]
    return "0x" + "".join(head + [w(len(amounts)), *map(w, amounts), w(len(addresses)), *map(w, addresses)])


TOPICS = [C.EXECUTED_REFUND, "0x" + w(8453), "0x" + w(7), "0x" + w(2)]


def test_all_columns_in_order(spark):
    row = decode(spark, TOPICS, refund_data([1], [2]))
    assert list(row.asDict()) == [*DECODED, "blockchain"]


def test_fill_with_large_amounts(spark):
    big = 3 * 10**24
    slots = [w(11), w(12), w(big), w(10**30), w(42161), w(1), w(2), w(13), w(14), w(15), w(16)]
    row = decode(spark, [C.FILLED_RELAY, "0x" + w(1), "0x" + w(77), "0x" + w(99)], "0x" + "".join(slots))
    assert row.topic_origin_chain_id == 1 and row.topic_deposit_id == 77
    assert row.topic_relayer == "0x" + w(99)[-40:]
    assert row.filled_relay_data_input_amount == float(big)
    assert row.filled_relay_data_output_amount == float(10**30)
    assert row.filled_relay_data_repayment_chain_id == 42161.0
    assert row.filled_relay_data_recipient == "0x" + w(15)[-40:]
    assert row.topic_depositor is None and row.funds_deposited_data_input_amount is None and row.refund_count is None
    assert row.gas_price_wei == 10**9 and row.gas_used is None


def test_truncated_data_is_null_not_zero(spark):
    row = decode(spark, [C.FUNDS_DEPOSITED, "0x" + w(1), "0x" + w(77), "0x" + w(99)], "0x" + w(1) + w(2) + w(3)[:40])
    assert row.funds_deposited_data_output_token == "0x" + w(2)[-40:]
    assert row.funds_deposited_data_input_amount is None and row.funds_deposited_data_recipient is None


def test_short_topics_and_unknown_events(spark):
    row, unknown, none = decode_all(
        spark, [([C.FILLED_RELAY], None), (["0x" + "1" * 64, "0x1"], "0x" + w(1) * 11), ([], "0x")]
    )
    assert row.topic_0 == C.FILLED_RELAY and row.topic_deposit_id is None and row.filled_relay_data_input_token is None
    row = unknown
    assert row.topic_chain_id is None and row.filled_relay_data_input_amount is None and row.refund_amounts is None
    assert none.topic_0 is None


def test_refund_arrays_stay_exact(spark):
    amounts = [1, 10**18 + 1, 2**64, 10**30 + 3, 2**256 - 1]
    row = decode(spark, TOPICS, refund_data(amounts, [0xAB, 2, 3, 4, 5], total=2**70))
    assert row.refund_amounts == ",".join(map(str, amounts))
    assert row.refund_addresses.split(",")[0] == "0x" + w(0xAB)[-40:]
    assert (row.refund_count, row.amount_to_return) == (5, float(2**70))
    assert (row.topic_chain_id, row.topic_root_bundle_id, row.topic_leaf_id) == (8453, 7, 2)


def test_empty_refund_arrays(spark):
    row = decode(spark, TOPICS, refund_data([], []))
    assert (row.refund_amounts, row.refund_addresses, row.refund_count) == ("", "", 0)


def test_malformed_refunds_are_null_throughout(spark):
    good = refund_data([5, 6], [7, 8])
    bad = {
        "cut": good[:-2],
        "odd": good + "0",
        "offset outside": refund_data([5], [7], first=10**6),
        "huge offset": refund_data([5], [7], second=2**250),
        "count too large": good.replace(w(2), w(50), 1),
        "dirty token padding": refund_data([5], [7], token=1 << 200),
        "dirty address padding": refund_data([5], [1 << 161]),
        "flag": refund_data([5], [7], flag=2),
        "not hex": good[:-1] + "g",
    }
    first, *rows = decode_all(spark, [(TOPICS, d) for d in (good, *bad.values())])
    assert first.refund_count == 2
    for name, row in zip(bad, rows, strict=True):
        fields = (row.amount_to_return, row.l2_token_address, row.refund_amounts, row.refund_addresses, row.refund_count)
        assert fields == (None,) * 5, name


def test_lost_logs_are_counted(spark):
    rows = [
        ([C.FILLED_RELAY, "0x1", "0x" + "f" * 64, "0x1"], "0x", "0x1", None, None, "0xaa", "base"),
        ([C.FILLED_RELAY, "0x1", "0x5", "0x1"], "0x", "0x1", None, None, "0xab", "base"),
        ([C.FILLED_RELAY, "0x1", "0x5", "0x1"], "0x", "0x1", None, None, "0xac", "nowhere"),
        ([], "0x", "0x1", None, None, "0xad", "base"),
    ]
    report = undecodable_logs(spark.createDataFrame(rows, SCHEMA), supported_chains(spark))
    found = {(r.blockchain, r.reason): r.rejected_logs for r in report.collect()}
    assert found == {
        ("base", "deposit id out of range"): 1, ("base", "data cut short"): 1, ("nowhere", "unknown chain"): 1, ("base", "unknown event"): 1
    }
