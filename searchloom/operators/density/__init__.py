"""Density clustering per topic (HDBSCAN with leaf selection and an epsilon).

Mutual reachability uses the distance to the ``min_samples``-th nearest other
point.  Clusters are the leaves of the condensed tree; the whole topic is never
one of them.  Ties between edges are broken by ``(weight, distance, a, b)``,
which makes the spanning tree, and so the result, independent of partitioning.
"""

from searchloom.operators.density.labels import cluster_labels, core_distances

__all__ = ["cluster_labels", "core_distances"]
