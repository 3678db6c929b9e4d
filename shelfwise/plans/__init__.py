"""Plans: registered queries, their SQL oracle, the batch chain and table
registration."""
