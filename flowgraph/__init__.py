"""flowgraph: network-flow graph analytics and threat retrieval as Spark DataFrame jobs."""
