"""Stage plans (Bronze, Silver, Gold, reports) and the registered checks."""
