"""DataFrame operators: parse/route/quarantine, replay and delete audit, synthesis, reconcile."""
