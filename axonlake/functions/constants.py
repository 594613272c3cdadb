"""Fixed values of the connectome domain."""

UNSPECIFIED = "<unspecified>"
#: Body statuses from worst to best; the place is the rank.
STATUSES = (
    "Unimportant", "Glia", "Hard to trace", "Orphan-artifact", "Orphan", "Orphan hotknife", "Putative Leaves",
    "Out of scope", "Not examined", "", "0.5assign", "Anchor", "Cleaved Anchor", "Will be merged", "Partially traced",
    "Sensory Anchor", "Cervical Anchor", "Soma Anchor", "Examined Soma Anchor", "Primary Anchor", "Leaves", "PRT Orphan",
    "Reviewed", "Prelim Roughly traced", "RT Hard to trace", "RT Orphan", "Roughly traced", "Traced in ROI", "Traced",
    "Finalized",
)
STATUS_RANK = {s: k for k, s in enumerate(STATUSES)}
#: Ranks at which the simplified status begins.
SIMPLE_FROM = {0: "Unimportant", 1: "Glia", 2: "Orphan", 6: "", 10: "Assign", 11: "Anchor", 20: "Traced"}
SIMPLE_STATUS = {s: SIMPLE_FROM[max(f for f in SIMPLE_FROM if f <= k)] for s, k in STATUS_RANK.items()}
SIGNIFICANT, TRACED = STATUS_RANK["Sensory Anchor"], STATUS_RANK["Leaves"]
#: Weight columns by the compartments of a connection's two ends.
COMPARTMENT_WEIGHTS = {
    "weightAxonDendrite": ("axon", "dendrite"),
    "weightAxonAxon": ("axon", "axon"),
    "weightDendriteDendrite": ("dendrite", "dendrite"),
    "weightDendriteAxon": ("dendrite", "axon"),
}
COMPARTMENTS = ("axon", "dendrite", "linker", "cell-body-fiber", "unknown")
#: First z of the ventral nerve cord; voxels of a region volume are 32 wide.
ZONE_CUT_Z, VOLUME_SHIFT = 45056, 5
#: Neurotransmitter thresholds.
NT_LIMITS = {"body_confidence": 0.5, "body_presyn": 50, "celltype_confidence": 0.5, "celltype_presyn": 100}
