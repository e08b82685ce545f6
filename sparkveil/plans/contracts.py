"""Column contracts, hash lists and gate parameters. They decide results."""

HISTORY = {
    "orcomp": "company_code", "orsocs": "source_customer_code", "orshcs": "ship_to_customer_code", "orshnm": "customer_name",
    "orpo": "purchase_order_number", "ornum": "order_number", "ortype": "order_type", "orodt8": "order_date",
    "orsdt8": "scheduled_ship_date", "orsdat": "shipped_date", "oruser": "created_by_user", "ordrte": "delivery_route",
    "orstat": "order_status", "orpoq": "ordered_quantity", "00015": "full_sku_code", "orman": "first_half_sku_code",
    "orprod": "unique_sku_code", "ordes1": "product_description", "orpoq2": "secondary_order_quantity",
    "orroq": "final_order_quantity", "orpsqt": "shipped_order_quantity", "00022": "quantity_short",
    "orpswt": "shipped_order_weight", "orpamt": "order_amount", "00025": "product_category", "batch_id": "batch_id",
    "ingested_at": "ingested_at_datetime",
}
OPEN_ORDERS = {
    "orcomp": "company_code", "orsocs": "source_customer_code", "orshcs": "ship_to_customer_code", "orshnm": "customer_name",
    "orpo": "purchase_order_number", "ornum": "order_number", "orodt8": "order_date", "orsdt8": "scheduled_ship_date",
    "orstat": "order_status", "orman": "first_half_sku_code", "orprod": "unique_sku_code", "ordes1": "product_description",
    "orroq": "final_order_quantity", "orpsqt": "shipped_order_quantity", "ortype": "order_type",
    "orpewt": "estimated_order_weight", "rtname": "delivery_route_name", "rtnumb": "delivery_route",
    "orrqdt": "customer_requested_date", "orrvdt": "revised_delivery_date", "orpswt": "shipped_order_weight",
    "00011": "full_sku_code", "orpamt": "order_amount", "batch_id": "batch_id", "ingested_at": "ingested_at_datetime",
}
INVENTORY = {
    "sku": "raw_sku", "description": "product_description", "pallet_no.": "pallet_number", "lot_no.": "lot_number",
    "slot": "slot_location", "pallet_held": "pallet_held_flag", "prod'n_date": "production_date", "bb_date": "best_before_date",
    "res_qty": "reserved_quantity", "qty": "quantity_on_hand", "wgt": "weight",
}
OPEN_DROPS = ["orsdat", "orpval", "oruser"]

HISTORY_HASH = [
    "company_code", "source_customer_code", "ship_to_customer_code", "customer_name", "purchase_order_number", "order_number",
    "order_type", "order_date", "scheduled_ship_date", "shipped_date", "delivery_route", "order_status", "ordered_quantity",
    "full_sku_code", "first_half_sku_code", "unique_sku_code", "final_order_quantity", "shipped_order_quantity",
    "quantity_short", "shipped_order_weight", "order_amount", "product_category", "product_description",
]
OPEN_HASH = [
    "company_code", "source_customer_code", "ship_to_customer_code", "customer_name", "purchase_order_number", "order_number",
    "order_type", "order_date", "scheduled_ship_date", "order_status", "full_sku_code", "first_half_sku_code",
    "unique_sku_code", "final_order_quantity", "shipped_order_quantity", "estimated_order_weight", "shipped_order_weight",
    "delivery_route", "customer_requested_date", "revised_delivery_date", "order_amount", "product_description",
]
INVENTORY_HASH = [
    "warehouse_code", "snapshot_date", "full_sku_code", "pallet_number", "lot_number", "slot_location", "production_date",
    "best_before_date", "reserved_quantity", "quantity_on_hand", "weight",
]

GATES = {
    "history": {
        "required": ["company_code", "customer_name", "purchase_order_number", "order_number", "order_type", "order_date", "scheduled_ship_date", "shipped_date", "delivery_route", "order_status", "ordered_quantity", "full_sku_code", "product_description", "product_category", "row_hash", "pseudonymized_at"],
        "critical": ["order_number", "full_sku_code", "customer_name", "product_description", "product_category", "row_hash"],
        "numeric": ["ordered_quantity", "final_order_quantity", "shipped_order_quantity", "shipped_order_weight", "order_amount"],
        "pseudonyms": ["customer", "product"],
    },
    "open": {
        "required": ["company_code", "customer_name", "purchase_order_number", "order_number", "order_type", "order_date", "scheduled_ship_date", "order_status", "full_sku_code", "product_description", "product_category", "row_hash", "pseudonymized_at"],
        "critical": ["order_number", "full_sku_code", "customer_name", "product_description", "row_hash"],
        "numeric": ["final_order_quantity", "shipped_order_quantity", "estimated_order_weight", "shipped_order_weight", "order_amount"],
        "pseudonyms": ["customer", "product"],
    },
    "inventory": {
        "required": ["warehouse_code", "snapshot_date", "full_sku_code", "product_description", "product_category", "quantity_on_hand", "row_hash", "pseudonymized_at"],
        "critical": ["full_sku_code", "product_description", "row_hash"],
        "numeric": ["reserved_quantity", "quantity_on_hand", "weight"],
        "pseudonyms": ["product", "sku"],
    },
}
VALIDATED = {
    "history": ["customer_name", "product_description", "product_category", "row_hash", "pseudonymized_at"],
    "open": ["customer_name", "product_description", "product_category", "row_hash", "pseudonymized_at"],
    "inventory": ["product_description", "product_category", "full_sku_code", "row_hash", "pseudonymized_at"],
}
CUSTOMER_MAPPING = ["customer_hash_key", "source_customer_code", "ship_to_customer_code", "customer_name", "pseudo_customer_name"]
PRODUCT_MAPPING = ["full_sku_code", "first_half_sku_code", "unique_sku_code", "product_description", "product_category", "pseudo_category", "pseudo_product_description", "pseudo_full_sku_code", "pseudo_first_half_sku_code", "pseudo_unique_sku_code"]
CATEGORIES = [("STANDARD", "Frozen Potato"), ("SMALL", "Fresh Produce"), ("LARGE", "Dry Goods"), ("PROMO", "Dairy Goods"), ("ECONOMY", "Widgets"), ("MEDIUM", "Unit Cases")]
UNKNOWN = "Unknown Category"
