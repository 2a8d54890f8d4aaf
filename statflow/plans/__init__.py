"""Query plans: end-to-end flows and the registered queries over the test tables."""
