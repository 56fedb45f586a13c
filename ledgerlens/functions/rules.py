"""Business rules of the reporting views as Column expressions.

Every rule takes column names (or Columns), so the same rule serves the
ERP-shaped views and any other table that carries the same meaning. CASE
order and three-valued logic follow the reporting SQL exactly: a NULL
condition is "not true" and falls through to the next branch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions import codes as K
from ledgerlens.functions.dates import as_of_date, day_span, to_date_col
from ledgerlens.functions.text import ColumnOrName, code_map, col, contains, first_nonblank, is_blank, regex_classify


def item_charge_type(item_text: ColumnOrName, material_charge_type: ColumnOrName) -> Column:
    """Damage / insurance / freight from the item text, else the material's charge type."""
    return regex_classify(item_text, K.CHARGE_TYPE_PATTERNS, default=material_charge_type)


def charge_frequency(charge_type: ColumnOrName) -> Column:
    return F.when(col(charge_type).isin(K.RECURRING_CHARGE_TYPES), F.lit(K.RECURRING)).otherwise(F.lit(K.ONE_OFF))


def charge_mode(charge_type: ColumnOrName, line_start: ColumnOrName, line_end: ColumnOrName,
                head_start: ColumnOrName, head_end: ColumnOrName) -> Column:
    """Full month, or prorated for mobilisation / demobilisation."""
    t = col(charge_type)
    ls, le, hs, he = (to_date_col(c) for c in (line_start, line_end, head_start, head_end))
    return (F.when(~t.isin(K.RECURRING_CHARGE_TYPES), F.lit(K.MODE_FULL))
            .when(day_span(ls, le) >= K.FULL_MONTH_DAYS, F.lit(K.MODE_FULL))
            .when(F.dayofmonth(ls) != F.dayofmonth(hs), F.lit(K.MODE_MOBILISATION))
            .when(F.dayofmonth(le) != F.dayofmonth(he), F.lit(K.MODE_DEMOBILISATION))
            .otherwise(F.lit(K.MODE_FULL)))


def _prorated(amount: Column, days: ColumnOrName) -> Column:
    return amount.cast("double") / K.FULL_MONTH_DAYS * col(days).cast("double")


def rental_amount(charge_type, order_status, mode, price, days) -> Column:
    t, s, m, p = col(charge_type), col(order_status), col(mode), col(price)
    rental = t.isin(K.RENTAL_CHARGE_TYPES)
    pending = s == K.ORDER_NO_MEASUREMENT
    return (F.when(rental & pending & (m != K.MODE_FULL) & (p > 0), _prorated(p, days))
            .when(rental & pending & (m == K.MODE_FULL) & (p > 0), p.cast("double"))
            .when(rental & (s != K.ORDER_NO_MEASUREMENT) & (p > 0), p.cast("double"))
            .otherwise(F.lit(0.0)))


def insurance_amount(charge_type, order_status, mode, price, insurance, days) -> Column:
    t, s, m, p, i = col(charge_type), col(order_status), col(mode), col(price), col(insurance)
    prorate = (s == K.ORDER_NO_MEASUREMENT) & (m != K.MODE_FULL)
    is_ins = t == K.INSURANCE
    return (F.when(is_ins & prorate & (i >= 0), _prorated(p + i, days))
            .when(is_ins & (i >= 0), (p + i).cast("double"))
            .when((i >= 0) & prorate, _prorated(i, days))
            .when(i >= 0, i.cast("double"))
            .otherwise(F.lit(0.0)))


def freight_amount(charge_type, price, freight) -> Column:
    t, p, f = col(charge_type), col(price), col(freight)
    return (F.when(t == K.FREIGHT, (p + f).cast("double"))
            .when(f < 0, F.lit(0.0))
            .otherwise(f.cast("double")))


def damage_amount(charge_type, price, damage) -> Column:
    t, p, d = col(charge_type), col(price), col(damage)
    return (F.when((t == K.DAMAGE) & (d == 0) & (p >= 0), p.cast("double"))
            .when(d < 0, F.lit(0.0))
            .otherwise(d.cast("double")))


def discount_amount(price, freight, insurance, discount) -> Column:
    """First negative of price / freight / insurance is netted with the discount."""
    p, f, i, d = col(price), col(freight), col(insurance), col(discount)
    return (F.when(p < 0, (p + d).cast("double"))
            .when(f < 0, (f + d).cast("double"))
            .when(i < 0, (i + d).cast("double"))
            .when(d < 0, d.cast("double"))
            .otherwise(F.lit(0.0)))


def other_amount(charge_type, price, discount, variable_hours, extra_hours) -> Column:
    t, p, d, v, x = col(charge_type), col(price), col(discount), col(variable_hours), col(extra_hours)
    return (F.when(t.isin(K.OTHER_CHARGE_TYPES) & (p > 0), p.cast("double"))
            .when(d > 0, d.cast("double"))
            .when(v > 0, v.cast("double"))
            .when(x > 0, x.cast("double"))
            .otherwise(F.lit(0.0)))


def final_price(blocked_flag: ColumnOrName, *components: ColumnOrName) -> Column:
    """0 when blocked, else the sum of the components with NULL read as 0."""
    total = None
    for c in components:
        term = F.coalesce(col(c).cast("double"), F.lit(0.0))
        total = term if total is None else total + term
    return F.when(col(blocked_flag) == K.YES, F.lit(0.0)).otherwise(total)


def yes_if_any_present(*cols: ColumnOrName) -> Column:
    """'Não' when every column is NULL, else 'Sim'."""
    all_null = None
    for c in cols:
        cond = col(c).isNull()
        all_null = cond if all_null is None else all_null & cond
    return F.when(all_null, F.lit(K.NO)).otherwise(F.lit(K.YES))


def contract_item_status(charge_type, item_end, item_start, billing_block, refusal, serial, as_of=None) -> Column:
    """'Ativo' when all nine conditions hold on ``as_of``, else 'Inativo'."""
    t, e, s = col(charge_type), col(item_end), col(item_start)
    today = as_of_date(as_of)
    active = (t.isin(K.RECURRING_CHARGE_TYPES)
              & e.isNotNull() & (e > today)
              & s.isNotNull() & (s <= today)
              & ~F.year(s).isin(K.PLACEHOLDER_YEARS)
              & col(billing_block).isNull()
              & col(refusal).isNull()
              & ~((t == K.MACHINE) & is_blank(serial)))
    return F.when(active, F.lit(K.ITEM_ACTIVE)).otherwise(F.lit(K.ITEM_INACTIVE))


def device_status(flag: ColumnOrName) -> Column:
    """Three states from a left-joined flag: returned, in use, no row."""
    f = col(flag)
    return (F.when(f == K.INACTIVE_FLAG, F.lit(K.DEVICE_RETURNED))
            .when(f != K.INACTIVE_FLAG, F.lit(K.DEVICE_IN_USE))
            .otherwise(F.lit(K.DEVICE_NOT_FOUND)))


def contract_type_from_profit_centre(profit_centre: ColumnOrName, marker: str = K.PROFIT_CENTRE_MARKER,
                                     pos: int = K.PROFIT_CENTRE_CHAR_POS,
                                     char_map=K.PROFIT_CENTRE_CHAR_MAP) -> Column:
    pc = col(profit_centre)
    return F.when(contains(pc, marker), F.lit(marker)).otherwise(code_map(F.substring(pc, pos, 1), char_map, ""))


def contract_type_from_order_type(order_type: ColumnOrName, with_consortium: bool) -> Column:
    pairs = K.ORDER_TYPE_CONTRACT if with_consortium else K.ORDER_TYPE_CONTRACT[:3]
    return code_map(order_type, pairs, "")


def override_or(matched: Column, override_value: ColumnOrName, fallback: Column) -> Column:
    """``CASE WHEN <matched> THEN override ELSE fallback END``."""
    return F.when(matched, col(override_value)).otherwise(fallback)


def order_status(billing_status: ColumnOrName) -> Column:
    return code_map(billing_status, K.ORDER_STATUS_MAP, K.ORDER_PENDING)


def reconciled_order_status(status: ColumnOrName) -> Column:
    """After the full join a missing order reads as 'BM PENDENTE'."""
    return code_map(status, [(K.ORDER_PENDING, K.ORDER_PENDING), (K.ORDER_BILLED, K.ORDER_BILLED)],
                    K.ORDER_NO_MEASUREMENT)


def contract_doc_status(overall_status: ColumnOrName) -> Column:
    """A/B/C -> label; anything else is shown as is."""
    return code_map(overall_status, K.CONTRACT_STATUS_MAP, col(overall_status))


def sale_or_return(item_category: ColumnOrName) -> Column:
    return F.when(col(item_category) == K.USED_SALE_CATEGORY, F.lit(K.SALE_LABEL)).otherwise(F.lit(K.RETURN_LABEL))


def signed_amount(item_category: ColumnOrName, amount: ColumnOrName) -> Column:
    a = col(amount)
    return F.when(col(item_category) == K.USED_SALE_CATEGORY, a).otherwise(-a)


def chassis_fallback(asset_no: ColumnOrName, chassis: ColumnOrName,
                     prefixes=K.ASSET_CHASSIS_FALLBACK_PREFIXES) -> Column:
    a = F.trim(col(asset_no))
    return F.when(F.substring(a, 1, 2).isin(list(prefixes)) & is_blank(chassis), a).otherwise(col(chassis))


def composite_value(asset_no, attached_no, value, attached_value, prefix=K.ASSET_COMPOSITE_PREFIX) -> Column:
    n = len(prefix)
    cond = (F.substring(col(asset_no), 1, n) == prefix) | (F.substring(col(attached_no), 1, n) == prefix)
    return F.when(cond, col(value) + F.coalesce(col(attached_value), F.lit(0))).otherwise(col(value))


def gross_price_choice(order_status_col, billed_price, order_price) -> Column:
    return F.when(col(order_status_col) == K.ORDER_BILLED, col(billed_price)).otherwise(col(order_price))


def profit_centre_name(profit_centre, dim_name) -> Column:
    return F.when(col(profit_centre) == K.DUMMY_PROFIT_CENTRE, F.lit(K.DUMMY_PROFIT_CENTRE_NAME)).otherwise(col(dim_name))


def contract_id_chain(order_parent, invoice_contract, relation_contract) -> Column:
    """Order's parent, else invoice's contract, else the relation's (blank = missing)."""
    return first_nonblank(order_parent, invoice_contract, relation_contract)


def material_or_undue(first, second) -> Column:
    return F.coalesce(col(first), col(second), F.lit(K.UNDUE_MATERIAL))
