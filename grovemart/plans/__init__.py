"""Jobs composed of sources and operators, and the registered queries."""
