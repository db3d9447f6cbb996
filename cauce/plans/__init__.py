"""Jobs composed from the operators: raw load, the three cleanings, the integration."""
