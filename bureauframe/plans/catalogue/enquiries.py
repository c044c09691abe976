"""Credit enquiries. Enquiries after the as-of date have no age and never qualify."""

from bureauframe.plans.features import (
    ENQUIRY,
    FeatureGroup,
    least_age,
    ratio,
    recent_count,
    recent_flag,
)

ENQUIRIES = FeatureGroup(
    "grp12_enquiries",
    ENQUIRY,
    (
        recent_count("total_enquiries", "mse"),
        *(recent_count(f"enquiry_in_last_{w}m", "mse", w) for w in (3, 6, 12, 24)),
        *(recent_count(f"enquiry_pl_last_{w}m", "mse", w, "pl") for w in (6, 12)),
        *(recent_count(f"enquiry_cc_last_{w}m", "mse", w, "cc") for w in (6, 12)),
        *(recent_count(f"enquiry_unsecured_last_{w}m", "mse", w, "unsecured") for w in (6, 12)),
        recent_count("enquiry_secured_last_12m", "mse", 12, "secured"),
        *(recent_count(f"enquiry_nbfc_last_{w}m", "mse", w, "nbfc") for w in (6, 12)),
        recent_count("enquiry_pvt_bank_last_12m", "mse", 12, "pvt"),
        least_age("months_since_last_enquiry", "mse"),
        least_age("months_since_last_pl_enquiry", "mse", "pl"),
        least_age("months_since_last_cc_enquiry", "mse", "cc"),
        recent_flag("flag_enquiry_last_1m", "mse", 1),
        recent_flag("flag_pl_enquiry_last_3m", "mse", 3, "pl"),
        recent_flag("flag_nbfc_enquiry_last_6m", "mse", 6, "nbfc"),
        ratio("ratio_unsecured_to_total_enq", "enquiry_unsecured_last_12m", "enquiry_in_last_12m"),
        ratio("ratio_nbfc_to_total_enq", "enquiry_nbfc_last_12m", "enquiry_in_last_12m"),
    ),
)
