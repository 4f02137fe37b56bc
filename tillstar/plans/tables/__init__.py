"""The rules of the twelve source tables."""

from tillstar.plans.tables import (
    customers,
    employees,
    inventory,
    order_items,
    orders,
    payments,
    products,
    promotions,
    returns,
    shipments,
    stores,
    suppliers,
)

TABLES = {
    module.RULES.name: module.RULES
    for module in (
        customers,
        products,
        stores,
        suppliers,
        employees,
        promotions,
        orders,
        order_items,
        payments,
        shipments,
        inventory,
        returns,
    )
}
