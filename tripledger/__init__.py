"""Payment reconciliation as Spark DataFrame jobs: production, issuer and bank views of the same money."""
