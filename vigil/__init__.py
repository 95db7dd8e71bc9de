"""vigil: a Spark-first engine that matches candidate hosts and pages against protected names."""
